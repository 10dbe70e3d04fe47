"""Exact duplicate removal of byte strings with suffix arrays.

Every window of ``width`` bytes has an anchor, the short string in it with the smallest hash (the leftmost of
equals); equal windows have equal anchors. Neighbouring windows with one anchor form a segment. A census of
the anchors drops those of one document only; the segments of the others meet by anchor, equal ones once per
run of documents, and a suffix array over a block of them brings equal windows together:

- suffixes smaller than their successor are sorted directly, by their leading bytes;
- the others are induced: scanning the buckets of the first byte in order, each suffix puts the one that
  begins a byte before it next into its bucket;
- neighbours whose common prefix has ``width`` bytes hold the same window, and the smallest document
  of such a run is the one that keeps it.

Documents with equal texts are one until the end. Windows go back to the documents of their run, never to a
place that collects all occurrences of a string, so that a passage in a third of the documents is no hot spot.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymart.llm.census import FINGERPRINT_BITS, fingerprint, joined, shared_features
from tallymart.llm.pieces import ranges
from tallymart.llm.shared import id_and_text, mix64, prefix_hashes, release_shuffles, slices, text_bytes
from tallymart.session import materialise, tune

HASH_RUN = 1 << 19  # bytes whose hashes are in memory at a time
RUN_BYTES = 12 << 20  # bytes of documents whose equal segments are told apart once
BLOCK_BYTES = 1 << 20  # bytes of segments in one suffix array


@dataclass(frozen=True)
class DedupRule:
    """Windows of ``width`` bytes with anchors of ``anchor`` bytes. Anchors with more than ``hot`` rows of
    segments are dealt out by window."""

    width: int = 50
    anchor: int = 20
    hot: int = 20_000


def anchors(data: np.ndarray, first: np.ndarray, rule: DedupRule) -> tuple[np.ndarray, ...]:
    """Segments of texts laid end to end: hash of the anchor, text, first window and last window of each."""
    empty = np.zeros(0, np.int64)
    reach = rule.width - rule.anchor + 1  # anchors to choose from in a window
    n = len(data) - rule.width + 1
    if n <= 0:
        return empty.astype(np.uint64), empty, empty, empty
    sums, back = prefix_hashes(data)
    hashes = mix64((sums[rule.anchor :] - sums[: -rule.anchor]) * back[: -rule.anchor])
    # the upper half of the hash, then the place: the smallest is the leftmost of the best
    least = (hashes & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(hashes), dtype=np.uint64)
    have = 1
    while have < reach:
        step = min(have, reach - have)
        least = np.minimum(least[:-step], least[step:])
        have += step
    place = (least[:n] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    inside = np.zeros(len(data) + 1, np.int64)  # windows that end in their text
    starts, stops = first[:-1], np.maximum(first[:-1], first[1:] - rule.width + 1)
    np.add.at(inside, starts, 1)
    np.add.at(inside, stops, -1)
    windows = np.flatnonzero(np.cumsum(inside[:n]) > 0)
    if not len(windows):
        return empty.astype(np.uint64), empty, empty, empty
    own = np.searchsorted(first, windows, side="right") - 1
    anchor = place[windows]
    new = np.r_[True, (anchor[1:] != anchor[:-1]) | (own[1:] != own[:-1])]
    last = np.r_[new[1:], True]
    return hashes[anchor[new]], own[new], windows[new], windows[last]


def _anchors_of(part: pa.RecordBatch, rule: DedupRule) -> Iterator[tuple]:
    """``anchors`` of a batch in runs: the bytes, the row of each segment and its places within the run."""
    row = 0
    for sub in slices([part.select(["text"])], "text", HASH_RUN):
        data, first = text_bytes(sub.column("text"))
        hashes, own, a, b = anchors(data, first, rule)
        yield data, first, hashes, own + row, own, a, b
        row += sub.num_rows


# Suffix arrays


def _words(data: np.ndarray, depth: int) -> np.ndarray:
    """At each place the next 8 bytes as a number that sorts like them; ``depth`` further zeros follow the end."""
    padded = np.concatenate([data, np.zeros(depth + 8, np.uint8)])
    words = np.zeros(len(padded) - 7, np.uint64)
    for k in range(8):
        words = (words << np.uint64(8)) | padded[k : len(padded) - 7 + k].astype(np.uint64)
    return words


def _sort_directly(suffixes: np.ndarray, words: np.ndarray, depth: int) -> np.ndarray:
    """``suffixes`` in the order of their first ``depth`` bytes; ties are sorted on, eight bytes at a time."""
    order = suffixes[np.argsort(words[suffixes], kind="stable")]
    key = words[order]
    new = np.r_[True, key[1:] != key[:-1]][: len(order)]
    for at in range(8, depth, 8):
        tied = np.flatnonzero(~(new & np.r_[new[1:], True][: len(new)]))
        if not len(tied):
            break
        group = np.cumsum(new)[tied]
        key = words[order[tied] + at]
        by = np.lexsort((key, group))
        order[tied] = order[tied][by]
        key, group = key[by], group[by]
        new[tied] = np.r_[True, (key[1:] != key[:-1]) | (group[1:] != group[:-1])]
    return order


def two_stage_suffix_array(data: np.ndarray, depth: int) -> np.ndarray:
    """All suffixes of ``data`` in the order of at least their first ``depth`` bytes.

    Stage one sorts the suffixes that are smaller than their successor. Stage two scans the buckets of the first
    byte upwards: a suffix that is larger than its successor goes to its bucket when its successor is met,
    before the bucket's directly sorted ones.
    """
    n = len(data)
    if n < 2:
        return np.arange(n)
    # smaller than the successor: the next different byte is larger; the end is smaller than anything
    rises = np.zeros(n, bool)
    change = np.flatnonzero(data[1:] != data[:-1])
    ups = data[change + 1] > data[change]
    run = np.searchsorted(change, np.arange(n))
    some = run < len(change)
    rises[some] = ups[run[some]]
    direct = _sort_directly(np.flatnonzero(rises), _words(data, depth), depth)
    bounds = np.searchsorted(data[direct], np.arange(257))
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    waiting[data[n - 1]].append(np.array([n - 1]))  # the successor of the last suffix is the end, which comes first
    out = []

    def induce(met: np.ndarray, byte: int) -> np.ndarray:
        """Put the predecessors of ``met`` into their buckets; those of this bucket are returned."""
        before = met[met > 0] - 1
        before = before[~rises[before]]
        heads = data[before]
        order = np.argsort(heads, kind="stable")
        before, heads = before[order], heads[order]
        edges = np.append(np.flatnonzero(np.r_[True, heads[1:] != heads[:-1]][: len(heads)]), len(heads))
        here = before[:0]
        for a, b in zip(edges, edges[1:], strict=False):
            if heads[a] == byte:
                here = before[a:b]
            else:
                waiting[heads[a]].append(before[a:b])
        return here

    for byte in range(256):
        met = np.concatenate(waiting[byte]) if waiting[byte] else np.zeros(0, np.int64)
        while len(met):
            out.append(met)
            met = induce(met, byte)
        sorted_ = direct[bounds[byte] : bounds[byte + 1]]
        if len(sorted_):
            out.append(sorted_)
            induce(sorted_, byte)
    return np.concatenate(out)


def smallest_holders(segments: list[bytes], first_doc: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every window of every segment the smallest document that holds it: segment, place, document."""
    sizes = np.array([len(s) for s in segments], np.int64)
    data = np.frombuffer(b"\0".join(segments) + b"\0", np.uint8)
    starts = np.cumsum(sizes + 1) - sizes - 1
    order = two_stage_suffix_array(data, width + 14)
    own = np.repeat(np.arange(len(sizes)), sizes + 1)
    at = np.arange(len(data)) - starts[own]
    order = order[at[order] + width <= sizes[own[order]]]  # a window that its segment holds
    # common prefix with the neighbour before: width bytes, or less
    words = _words(data, width)
    same = np.ones(max(0, len(order) - 1), bool)
    for k in [*range(0, width - 7, 8), width - 8]:
        left = np.flatnonzero(same)
        same[left] = words[order[left] + k] == words[order[left + 1] + k]
    edges = np.flatnonzero(np.r_[True, ~same][: len(order)])
    least = np.minimum.reduceat(first_doc[own[order]], edges) if len(edges) else first_doc[:0]
    holder = np.repeat(least, np.diff(np.append(edges, len(order))))
    back = np.argsort(order)
    return own[order][back], at[order][back], holder[back]


# The job

SEGMENTS = "run long, no int, anchor long, segment binary, first_doc long, last_doc long, uses binary"
SEGMENT_ARROW = pa.schema([
    ("run", pa.int64()), ("no", pa.int32()), ("anchor", pa.int64()), ("segment", pa.binary()), ("first_doc", pa.int64()), ("last_doc", pa.int64()), ("uses", pa.binary()),
])
USE = np.dtype([("no", "<u4"), ("row", "<u4"), ("at", "<u8")])
ANSWER = np.dtype([("no", "<u4"), ("at", "<u4"), ("windows", "<u4"), ("holder", "<i8")])


def _squeeze(values: np.ndarray) -> bytes:
    """A structured array, field by field."""
    return zstandard.ZstdCompressor(level=1).compress(b"".join(np.ascontiguousarray(values[f]).tobytes() for f in values.dtype.names))


def _unsqueeze(data: bytes, dtype: np.dtype) -> np.ndarray:
    data = zstandard.ZstdDecompressor().decompress(data)
    n, at = len(data) // dtype.itemsize, 0
    out = np.zeros(n, dtype)
    for f in dtype.names:
        size = dtype[f].itemsize * n
        out[f] = np.frombuffer(data[at : at + size], dtype[f])
        at += size
    return out


def _segments(texts: DataFrame, rule: DedupRule) -> DataFrame:
    """Segments with a shared anchor of ``texts`` (doc_id, sign, text, tokens).

    One row per run and distinct segment; one more per run (no = -1) says where its documents use them.
    """

    def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in slices(batches, "text", RUN_BYTES):
            values, bounds = joined(run.column("tokens"))
            shift = np.uint64(FINGERPRINT_BITS)
            mask = np.uint64((1 << FINGERPRINT_BITS) - 1)
            rows = np.repeat(np.arange(run.num_rows, dtype=np.uint64), np.diff(bounds))
            wanted = np.sort(rows << shift | values & mask)
            found, prints, row, at = [], [], [], []
            for data, first, hashes, own, local, a, b in _anchors_of(run, rule):
                key = own.astype(np.uint64) << shift | fingerprint(hashes)
                place = np.searchsorted(wanted, key)
                hit = np.flatnonzero(wanted[np.minimum(place, len(wanted) - 1)] == key) if len(wanted) else np.zeros(0, np.int64)
                if not len(hit):
                    continue
                sizes = b[hit] - a[hit] + rule.width
                body = ranges(data, a[hit], sizes)
                offsets = np.r_[0, np.cumsum(sizes)].astype(np.int64)
                found.append(pa.Array.from_buffers(pa.large_binary(), len(hit), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(body))]))
                prints.append(fingerprint(hashes[hit]))
                row.append(own[hit])
                at.append(a[hit] - first[local[hit]])
            if not found:
                continue
            coded = pa.concat_arrays(found).dictionary_encode()
            no, distinct = coded.indices.to_numpy(zero_copy_only=False), coded.dictionary
            row, docs = np.concatenate(row), run.column("doc_id").to_numpy()
            n = len(distinct)
            first_doc, last_doc = np.full(n, np.iinfo(np.int64).max), np.full(n, np.iinfo(np.int64).min)
            np.minimum.at(first_doc, no, docs[row])
            np.maximum.at(last_doc, no, docs[row])
            anchor = np.zeros(n, np.int64)
            anchor[no] = np.concatenate(prints).astype(np.int64)
            uses = np.zeros(len(no), USE)
            uses["no"], uses["row"], uses["at"] = no, row, np.concatenate(at)
            name = uuid.uuid4().int >> 65
            for k in range(0, n, 20_000):
                m = min(20_000, n - k)
                columns = [[name] * m, np.arange(k, k + m, dtype=np.int32), anchor[k : k + m], distinct.slice(k, m).cast(pa.binary()), first_doc[k : k + m], last_doc[k : k + m], [None] * m]
                yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, SEGMENT_ARROW, strict=True)], schema=SEGMENT_ARROW)
            names = np.zeros(run.num_rows, [("doc", "<i8"), ("sign", "<i8")])
            names["doc"], names["sign"] = docs, run.column("sign").to_numpy()
            packed = _squeeze(names)
            packed = len(packed).to_bytes(8, "little") + packed + _squeeze(uses)
            yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip((name, -1, None, None, None, None, packed), SEGMENT_ARROW, strict=True)], schema=SEGMENT_ARROW)

    return texts.mapInArrow(find, SEGMENTS)


def _answers(segments: DataFrame, partitions: int, rule: DedupRule) -> DataFrame:
    """Per run what its segments' windows lose to: run, answers (packed rows of ANSWER)."""

    def solve(rows: list[tuple], distinct: dict[bytes, int]) -> Iterator[pa.RecordBatch]:
        run, no, place, which, first, last = (np.array([r[k] for r in rows], np.int64) for k in range(6))
        first_doc = np.full(len(distinct), np.iinfo(np.int64).max)
        np.minimum.at(first_doc, which, first)
        segment, at, holder = smallest_holders(list(distinct), first_doc, rule.width)
        # the windows of a segment for each row that has it
        begin = np.searchsorted(segment, np.arange(len(distinct) + 1))
        n = np.diff(begin)[which]
        picked = ranges(np.arange(len(segment)), begin[which], n)
        own = np.repeat(np.arange(len(rows)), n)
        at, holder = at[picked], holder[picked]
        lost = holder < last[own]  # some document of the run has a larger id than the holder
        own, at, holder = own[lost], at[lost], holder[lost]
        if not len(own):
            return
        # neighbouring windows of a segment with one holder
        new = np.r_[True, (own[1:] != own[:-1]) | (at[1:] != at[:-1] + 1) | (holder[1:] != holder[:-1])]
        starts = np.flatnonzero(new)
        out = np.zeros(len(starts), ANSWER)
        out["no"], out["at"], out["holder"] = no[own[starts]], at[starts] + place[own[starts]], holder[starts]
        out["windows"] = np.diff(np.append(starts, len(own)))
        of = run[own[starts]]
        order = np.argsort(of, kind="stable")
        of, out = of[order], out[order]
        edges = np.append(np.flatnonzero(np.r_[True, of[1:] != of[:-1]]), len(of))
        packed = [_squeeze(out[a:b]) for a, b in zip(edges, edges[1:], strict=False)]
        yield pa.RecordBatch.from_pydict({"run": pa.array(of[edges[:-1]]), "answers": pa.array(packed, pa.binary())})

    def blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, distinct, size, group = [], {}, 0, None
        names = ("run", "no", "place", "segment", "first_doc", "last_doc", "anchor", "part")
        for batch in batches:  # sorted by anchor and part
            for run, no, place, segment, first, last, *own in zip(*(batch.column(c).to_pylist() for c in names), strict=True):
                if size > BLOCK_BYTES and own != group:
                    yield from solve(rows, distinct)
                    rows, distinct, size = [], {}, 0
                known = len(distinct)
                which = distinct.setdefault(segment, known)
                size += len(segment) * (which == known)
                rows.append((run, no, place, which, first, last))
                group = own
        if rows:
            yield from solve(rows, distinct)

    given = segments.filter("no >= 0").select("run", "no", "anchor", "segment", "first_doc", "last_doc")
    hot = materialise(given.groupBy("anchor").agg(F.count("*").alias("rows")).filter(F.col("rows") > rule.hot).select("anchor"), "hot-anchors")
    whole = given.join(hot, "anchor", "left_anti").select("*", F.lit(0).alias("place"), F.lit(0).cast("long").alias("part"))
    # window by window: what meets is one window at most once per run
    windows = F.sequence(F.lit(0), F.length("segment") - rule.width)
    single = given.join(hot, "anchor", "left_semi").withColumn("place", F.explode(windows))
    single = single.withColumn("segment", F.substring("segment", F.col("place") + 1, F.lit(rule.width))).withColumn("part", F.xxhash64("segment"))
    columns = ["run", "no", "place", "segment", "first_doc", "last_doc", "anchor", "part"]
    met = whole.select(columns).unionByName(single.select(columns)).repartition(partitions, "anchor", "part").sortWithinPartitions("anchor", "part")
    return met.mapInArrow(blocks, "run long, answers binary")


def _spans(segments: DataFrame, answers: DataFrame, rule: DedupRule) -> DataFrame:
    """Per document that loses bytes: doc_id, sign, spans (starts, then ends, as packed 64-bit integers)."""

    def spread(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for packed, blobs in zip(batch.column("uses").to_pylist(), batch.column("answers").to_pylist(), strict=True):
                size = int.from_bytes(packed[:8], "little")
                names = _unsqueeze(packed[8 : 8 + size], np.dtype([("doc", "<i8"), ("sign", "<i8")]))
                uses = _unsqueeze(packed[8 + size :], USE)
                told = np.sort(np.concatenate([_unsqueeze(b, ANSWER) for b in blobs]), order="no", kind="stable")
                lo, hi = np.searchsorted(told["no"], uses["no"]), np.searchsorted(told["no"], uses["no"], side="right")
                use = np.repeat(np.arange(len(uses)), hi - lo)
                which = ranges(np.arange(len(told)), lo, hi - lo)
                row = uses["row"][use]
                lost = told["holder"][which] < names["doc"][row]
                use, which, row = use[lost], which[lost], row[lost].astype(np.int64)
                start = uses["at"][use].astype(np.int64) + told["at"][which]
                end = start + told["windows"][which] + rule.width - 1
                docs, signs, spans = [], [], []
                order = np.lexsort((start, row))
                row, start, end = row[order], start[order], end[order]
                edges = np.append(np.flatnonzero(np.r_[True, row[1:] != row[:-1]][: len(row)]), len(row))
                for a, b in zip(edges, edges[1:], strict=False):
                    upto = np.maximum.accumulate(end[a:b])
                    new = np.r_[True, start[a + 1 : b] > upto[:-1]]
                    own = np.concatenate([start[a:b][new], upto[np.r_[new[1:], True]]])
                    docs.append(int(names["doc"][row[a]]))
                    signs.append(int(names["sign"][row[a]]))
                    spans.append(own.astype("<i8").tobytes())
                yield pa.RecordBatch.from_pydict({"doc_id": pa.array(docs, pa.int64()), "sign": pa.array(signs, pa.int64()), "spans": pa.array(spans, pa.binary())})

    told = answers.groupBy("run").agg(F.collect_list("answers").alias("answers"))
    used = segments.filter("no < 0").select("run", "uses")
    return used.join(told, "run").select("uses", "answers").mapInArrow(spread, "doc_id long, sign long, spans binary")


def _cut(data: bytes, spans: bytes) -> tuple[bytes, int, int]:
    """What is left of a text, how many bytes are gone, and in how many spans."""
    starts, ends = np.frombuffer(spans, "<i8").reshape(2, -1)
    left = b"".join(data[a:b] for a, b in zip([0, *ends.tolist()], [*starts.tolist(), len(data)], strict=True))
    return left, len(data) - len(left), len(starts)


def find_spans(docs: DataFrame, rule: DedupRule = DedupRule(), id_col="doc_id", text_col="text") -> tuple[DataFrame, DataFrame]:
    """What a document repeats of documents with smaller ids.

    Returns, both stored: per row doc_id, n_bytes, sha (of its text), sign and first (the smallest id with its text);
    and per first document that loses bytes doc_id, sign and spans.
    """
    spark = tune(docs.sparkSession)
    rows = id_and_text(docs, id_col, text_col).withColumn("text", F.coalesce("text", F.lit("")))
    sha = F.unhex(F.sha2("text", 256))
    signed = rows.withColumn("sha", sha).withColumn("sign", F.conv(F.substring(F.hex("sha"), 1, 15), 16, 10).cast("long"))
    listed = signed.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "sha", "sign")
    listed = materialise(listed, "dedup-texts")
    firsts = listed.groupBy("sha").agg(F.min("doc_id").alias("first"))
    listed = materialise(listed.join(firsts, "sha"), "dedup-listed")
    total = listed.agg(F.sum("n_bytes")).first()[0] or 0
    # texts that are first with their bytes: no copies, no short ones, none without an id
    chosen = listed.filter((F.col("doc_id") == F.col("first")) & (F.col("n_bytes") >= rule.width))
    chosen = materialise(chosen.select("doc_id", "sign").distinct(), "dedup-chosen")
    texts = signed.select("doc_id", "sign", "text")

    def emit(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        found = [(hashes, own) for _, _, hashes, own, *_ in _anchors_of(part, rule)]
        return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])

    expected = 2 * total // (rule.width - rule.anchor + 2)
    shared = materialise(shared_features(texts.join(chosen, ["doc_id", "sign"]), emit, expected), "dedup-anchors")
    release_shuffles(spark)
    segments = materialise(_segments(texts.join(shared.join(chosen, "doc_id"), ["doc_id", "sign"]).select("doc_id", "sign", "text", "tokens"), rule), "dedup-segments")
    release_shuffles(spark)
    size = segments.agg(F.sum(F.length("segment"))).first()[0] or 0
    answers = materialise(_answers(segments, max(1, round(size / (8 * BLOCK_BYTES))), rule), "dedup-answers")
    release_shuffles(spark)
    return listed, materialise(_spans(segments, answers, rule), "dedup-spans")


def _digests(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """Per document with spans: doc_id, sign, n_removed, n_spans, kept_sha256."""

    def digest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            cut = [_cut(t.encode(), s) for t, s in zip(part.column("text").to_pylist(), part.column("spans").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("sign"), pa.array([c[1] for c in cut], pa.int64()), pa.array([c[2] for c in cut], pa.int64()), pa.array([hashlib.sha256(c[0]).hexdigest() for c in cut], pa.string())],
                ["doc_id", "sign", "n_removed", "n_spans", "kept_sha256"],
            )

    signed = docs.withColumn("sign", F.conv(F.substring(F.sha2("text", 256), 1, 15), 16, 10).cast("long"))
    return signed.join(spans, ["doc_id", "sign"]).select("doc_id", "sign", "text", "spans").mapInArrow(digest, "doc_id long, sign long, n_removed long, n_spans long, kept_sha256 string")


def dedup_report(docs: DataFrame, rule: DedupRule = DedupRule(), id_col="doc_id", text_col="text") -> DataFrame:
    """Per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    A byte goes if a string of ``width`` bytes that covers it also starts in a document with a smaller id. A null text
    is empty. Rows with a null id lose nothing and take nothing; rows that share an id are not compared.
    Texts shorter than ``width`` bytes stay whole.
    """
    listed, spans = find_spans(docs, rule, id_col, text_col)
    rows = id_and_text(docs, id_col, text_col).filter("doc_id IS NOT NULL AND text IS NOT NULL")
    cut = materialise(_digests(rows, spans).dropDuplicates(["doc_id", "sign"]), "dedup-digests")
    copy = F.coalesce((F.col("doc_id") > F.col("first")) & (F.col("n_bytes") >= rule.width), F.lit(False))
    empty = hashlib.sha256(b"").hexdigest()
    return listed.join(cut, ["doc_id", "sign"], "left").select(
        "doc_id",
        "n_bytes",
        F.when(copy, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(copy, 1).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(copy, F.lit(empty)).otherwise(F.coalesce("kept_sha256", F.lower(F.hex("sha")))).alias("kept_sha256"),
    )
