"""Quality rules: base counts per document, and repetition found with a suffix array of its words.

The words of a run of documents form one array; its suffixes are sorted by prefix doubling with the
document as the first key, so that suffixes of different documents never meet and short documents cost
no more than long ones. Neighbours in the suffix array whose common prefix has ``min_repeat`` words or
more belong to a longest-common-prefix interval: their prefixes are repeats. Every position keeps its
longest repeat; those not inside their predecessor's are the maximal repeated substrings. The union of
their spans gives the covered share of the words, the longest of them the longest repeat.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from tallymart.llm.shared import id_and_text, slices, split_words

# Fixed values of the base rules.
SYMBOLS = "[#*$%&|<>]"
SPACE = "[\\x20\\x09-\\x0D]"
BASE_MIN_WORDS = 50
BASE_MAX_REPEAT_PERCENT = 50
WINDOW = 3

RUN_BYTES = 1 << 20  # texts judged at a time; arrays and lists of their words take about 25 times that


@dataclass(frozen=True)
class RepetitionRule:
    """A document is kept if repeats of ``min_repeat`` words or more cover at most ``max_covered`` of its
    words and none is longer than ``max_longest`` of them."""

    min_repeat: int = 8
    max_covered: float = 0.45
    max_longest: float = 0.25


def suffix_ranks(codes: np.ndarray, owner: np.ndarray, settle: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array of many sequences at once, ``owner`` first, and each suffix's rank.

    Doubling: the first ``h`` symbols are ranked, and suffixes that still tie are sorted by the rank of
    what follows ``h`` symbols later. Only ties are sorted again. With ``settle``, stops when ``settle``
    symbols are ranked; suffixes that tie have one rank then.
    """
    n = len(codes)
    ends = np.append(np.flatnonzero(owner[1:] != owner[:-1]) + 1, n) if n else np.zeros(0, np.int64)
    end_of = np.repeat(ends, np.diff(np.r_[0, ends]))
    key = owner.astype(np.int64) * (int(codes.max()) + 1 if n else 1) + codes
    order = np.argsort(key, kind="stable")
    rank = np.empty(n, np.int64)
    rank[order] = _group_starts(key[order])
    sizes = np.bincount(rank, minlength=n)
    open_ = np.flatnonzero(sizes[rank[order]] > 1)  # places in the suffix array
    h = 1
    while len(open_) and (settle is None or h < settle):
        suffix = order[open_]
        later = suffix + h
        inside = later < end_of[suffix]
        second = np.where(inside, rank[np.where(inside, later, 0)], -1)
        first = rank[suffix]
        by = np.lexsort((second, first))
        suffix, first, second = suffix[by], first[by], second[by]
        order[open_] = suffix
        new = np.r_[True, (first[1:] != first[:-1]) | (second[1:] != second[:-1])]
        rank[suffix] = open_[np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))]
        last = np.r_[new[1:], True]
        open_ = open_[~(new & last)]
        h *= 2
    return order, rank


def _group_starts(ordered: np.ndarray) -> np.ndarray:
    new = np.r_[True, ordered[1:] != ordered[:-1]][: len(ordered)]
    return np.maximum.accumulate(np.where(new, np.arange(len(ordered)), 0))


def longest_repeats(codes: np.ndarray, owner: np.ndarray, shortest: int) -> np.ndarray:
    """Per position the length of the longest repeat of its sequence that begins there; 0 if below ``shortest``.

    Only suffixes whose first symbols occur twice are sorted to the end. Common prefixes follow Kasai: along
    the text a common prefix shrinks by one symbol at most, so each symbol is compared a bounded number of times.
    """
    n, longest = len(codes), np.zeros(len(codes), np.int64)
    if not n:
        return longest
    enough = 1 << max(0, shortest.bit_length() - 1)  # the power of two at or below
    _, rank = suffix_ranks(codes, owner, enough)
    tied = np.flatnonzero(np.bincount(rank, minlength=n)[rank] > 1)
    if not len(tied):
        return longest
    # the documents with ties, sorted to the end
    with_ties = np.isin(owner, np.unique(owner[tied]))
    at = np.flatnonzero(with_ties)
    codes, owner = codes[at], owner[at]
    order, _ = suffix_ranks(codes, owner)
    place = np.empty(len(at), np.int64)
    place[order] = np.arange(len(at))
    new_place = np.full(n, -1, np.int64)
    new_place[at] = np.arange(len(at))
    tied = new_place[tied]
    before = np.where(place[tied] > 0, order[place[tied] - 1], -1)
    seq, own = codes.tolist(), owner.tolist()
    n = len(seq)
    found = np.zeros(n, np.int64)  # common prefix with the suffix before, at its place in the text
    common, previous = 0, -2
    for i, j in zip(tied.tolist(), before.tolist(), strict=True):
        common = common - 1 if i == previous + 1 and common > 0 else 0
        previous = i
        if j < 0 or own[i] != own[j]:
            common = 0
            continue
        top, doc = n - max(i, j), own[i]
        while common < top and seq[i + common] == seq[j + common] and own[i + common] == doc and own[j + common] == doc:
            common += 1
        found[i] = common
    best = found.copy()
    has = np.flatnonzero(found)
    np.maximum.at(best, order[place[has] - 1], found[has])
    best[best < shortest] = 0
    longest[at] = best
    return longest


def covered(longest: np.ndarray) -> np.ndarray:
    """Mask of the positions inside a repeat; no repeat leaves its sequence, so spans may be laid end to end."""
    starts = np.flatnonzero(longest)
    change = np.zeros(len(longest) + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + longest[starts], -1)
    return np.cumsum(change[:-1]) > 0


def _sum_by(owner: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(owner, weights=values, minlength=n).astype(np.int64)


def _repeated_lines(text: str | None) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in (text or "").split("\n") if x.strip(" \t\n\v\f\r")]
    return len(lines) - len(set(lines))


def measure(texts: pa.Array, rule: RepetitionRule = RepetitionRule()) -> dict[str, np.ndarray]:
    """All measures of an array of texts; a null or empty text has no words and zeros."""
    n = len(texts)
    words, first = split_words(texts)
    n_words = np.diff(first)
    owner = np.repeat(np.arange(n), n_words)
    codes = words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    chars = pc.utf8_length(words).to_numpy(zero_copy_only=False) if len(words) else np.zeros(0)
    # windows of three words: rank of the first two, then the third
    in_window = np.zeros(len(codes) + 1, np.int64)
    if len(codes) >= WINDOW:
        starts = np.flatnonzero(owner[WINDOW - 1 :] == owner[: 1 - WINDOW])
        key = np.stack([owner[starts], *(codes[starts + k] for k in range(WINDOW))])
        by = np.lexsort(key[::-1])
        new = np.r_[True, (key[:, by[1:]] != key[:, by[:-1]]).any(0)][: len(by)]
        twice = by[~(new & np.r_[new[1:], True][: len(by)])]
        np.add.at(in_window, starts[twice], 1)
        np.add.at(in_window, starts[twice] + WINDOW, -1)
    longest = longest_repeats(codes, owner, rule.min_repeat)
    top = np.zeros(n, np.int64)
    np.maximum.at(top, owner, longest)
    plain = pc.fill_null(texts, "")
    return {
        "n_words": n_words,
        "word_chars": _sum_by(owner, chars, n),
        "n_symbols": pc.count_substring_regex(plain, SYMBOLS).to_numpy(zero_copy_only=False).astype(np.int64),
        "n_dup_lines": np.fromiter((_repeated_lines(x) for x in texts.to_pylist()), np.int64, n),
        "n_repeat_words": _sum_by(owner, np.cumsum(in_window[:-1]) > 0, n),
        "covered_words": _sum_by(owner, covered(longest), n),
        "longest_repeat": top,
    }


def judge(found: dict[str, np.ndarray], rule: RepetitionRule = RepetitionRule()) -> tuple[np.ndarray, np.ndarray]:
    """base_failed and kept."""
    n = found["n_words"]
    failed = (n < BASE_MIN_WORDS) | (100 * found["n_repeat_words"] > BASE_MAX_REPEAT_PERCENT * n)
    calm = (found["covered_words"] <= rule.max_covered * n) & (found["longest_repeat"] <= rule.max_longest * n)
    return failed, ~failed & calm


REPORT = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, covered_words long, longest_repeat long"
)


def quality_report(docs: DataFrame, rule: RepetitionRule = RepetitionRule(), id_col="doc_id", text_col="text") -> DataFrame:
    """Per row of ``docs`` its counts, ``base_failed`` and ``kept``; no shuffle.

    A null or empty text has no words, so it fails the base rules. Repeated rows are judged alike, an empty
    table gives no rows, and a text of any length is one unit of work, never cut.
    """

    def report(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", RUN_BYTES):
            found = measure(part.column("text"), rule)
            failed, kept = judge(found, rule)
            base = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
            columns = {"doc_id": part.column("doc_id"), **{c: pa.array(found[c]) for c in base}, "base_failed": pa.array(failed), "kept": pa.array(kept)}
            columns |= {c: pa.array(found[c]) for c in ("covered_words", "longest_repeat")}
            yield pa.RecordBatch.from_pydict(columns)

    return id_and_text(docs, id_col, text_col).mapInArrow(report, REPORT)


def keep_good(docs: DataFrame, rule: RepetitionRule = RepetitionRule(), text_col="text") -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns."""
    place = docs.columns.index(text_col)

    def keep(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = [f"c{k}" for k in range(batch.num_columns)]  # names may repeat
            for part in slices([batch.rename_columns(names)], names[place], RUN_BYTES):
                _, kept = judge(measure(part.column(place), rule), rule)
                yield part.filter(pa.array(kept)).rename_columns(batch.schema.names)

    return docs.mapInArrow(keep, docs.schema)
