"""How the sources of each language differ in their words.

Terms are counted once per language, source and term; the terms that enough documents of a language hold are
kept. A term's divergence in a source depends on two counts only, the source's and the language's, so terms are
grouped by (source count, language count): a formula is worked out once per cell, not per term. Cells of one
group are ranked by value, equal values become one, and the cumulative number of terms tells which cells reach
the head of the list. Only those are expanded to terms, in UTF-8 order.

Pairs of sources are summed over all kept terms in blocks of sources: a task holds the shares of a run of terms
as a matrix of at most ``block`` sources a side and gives one sum per pair. Terms that neither side has are worth
one number per pair and are only counted.

Shares and divergences are whole numbers throughout, so the order of rows changes nothing.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymart.llm.shared import slices, text_bytes
from tallymart.session import materialise, tune

RUN_BYTES = 8 << 20  # texts counted at a time


@dataclass(frozen=True)
class DivergenceRule:
    """Terms of at least ``least_docs`` documents of a language are kept; ``top`` terms are listed per group.

    A matrix has up to ``block`` sources a side and about ``run_terms`` terms, which bounds memory and not the result.
    """

    least_docs: int = 10
    top: int = 10
    block: int = 128
    run_terms: int = 4096


# Bytes of a term are the ASCII letters and all bytes of other characters.
_IS_TERM = np.zeros(256, bool)
_IS_TERM[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

PARTS_PER_BILLION = 1_000_000_000


def terms_of(text: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All terms of an array of texts, A-Z as a-z, and the text of each."""
    data, first = text_bytes(text)
    inside = _IS_TERM[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    edges = first[:-1][first[:-1] < len(data)]
    begins[edges] = inside[edges]  # a text's terms do not join the next text's
    start = np.flatnonzero(begins)
    kept = data[inside]
    kept = np.where((kept >= 0x41) & (kept <= 0x5A), kept + 32, kept).astype(np.uint8)
    # where the terms begin once everything between them is gone
    offsets = np.r_[np.cumsum(inside)[start] - 1, len(kept)].astype(np.int64)
    terms = pa.Array.from_buffers(pa.large_string(), len(start), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(kept))])
    return terms, np.searchsorted(first, start, side="right") - 1


def _first_counts(rows: DataFrame) -> DataFrame:
    """Per run of rows (lang, source, text): lang, source, term, n occurrences, docs that hold it."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", RUN_BYTES):
            terms, owner = terms_of(part.column("text"))
            if not len(terms):
                continue
            lang, source = (part.column(c).dictionary_encode() for c in ("lang", "source"))
            n_sources, coded = len(source.dictionary), terms.dictionary_encode()
            group = lang.indices.to_numpy().astype(np.int64) * n_sources + source.indices.to_numpy()
            term, n_terms = coded.indices.to_numpy().astype(np.int64), len(coded.dictionary)
            in_doc, n = np.unique(owner * n_terms + term, return_counts=True)
            # the same by group: a document's terms are once each there
            key = group[in_doc // n_terms] * n_terms + in_doc % n_terms
            order = np.argsort(key, kind="stable")
            key, n = key[order], n[order]
            at = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            group, term = np.divmod(key[at], n_terms)
            total, docs = np.add.reduceat(n, at), np.diff(np.r_[at, len(key)])
            for a in range(0, len(at), 100_000):
                b = slice(a, a + 100_000)
                yield pa.RecordBatch.from_arrays(
                    [
                        lang.dictionary.take(pa.array(group[b] // n_sources)),
                        source.dictionary.take(pa.array(group[b] % n_sources)),
                        coded.dictionary.take(pa.array(term[b])).cast(pa.string()),
                        pa.array(total[b].astype(np.int64)),
                        pa.array(docs[b].astype(np.int64)),
                    ],
                    ["lang", "source", "term", "n", "docs"],
                )

    return rows.mapInArrow(count, "lang string, source string, term string, n long, docs long")


def _share(n: Column, total: Column, terms: Column) -> Column:
    """p = 1 + floor(10^9 * (n + 2) / (total + 2 * terms)); decimals hold what would overflow a long."""
    above = (n + 2).cast("decimal(20,0)") * F.lit(PARTS_PER_BILLION).cast("decimal(10,0)")
    below = (total + 2 * terms).cast("decimal(20,0)")
    return F.call_function("div", above, below) + 1


def _divergence(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / (p + q)); with shares of at most 10^9 + 1 the square fits a long."""
    return F.call_function("div", (p - q) * (p - q), p + q)


def _divergences(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


@dataclass(frozen=True)
class Counts:
    """What both parts of the audit are worked out from; all stored.

    ``groups``: lang, source, total, terms (kept ones of the language), lang_total.
    ``kept``: lang, source, term, n, lang_n; only rows with n > 0.
    """

    groups: DataFrame
    kept: DataFrame


def count_terms(docs: DataFrame, rule: DivergenceRule = DivergenceRule(), lang_col="lang", source_col="source", text_col="text") -> Counts:
    tune(docs.sparkSession)
    rows = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))))
    counted = _first_counts(rows).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    counted = materialise(counted, "term-counts")
    wanted = counted.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs")).filter(F.col("docs") >= rule.least_docs)
    wanted = materialise(wanted.drop("docs"), "wanted-terms")
    kept = materialise(counted.join(wanted, ["lang", "term"]).select("lang", "source", "term", "n", "lang_n"), "kept-terms")
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    langs = wanted.groupBy("lang").agg(F.sum("lang_n").alias("lang_total"), F.count("*").alias("terms"))
    groups = rows.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
    return Counts(materialise(groups.na.fill(0), "term-groups"), kept)


def top_terms(counts: Counts, rule: DivergenceRule = DivergenceRule()) -> DataFrame:
    """lang, source, item, value, rank: the terms that a source has more of than its language, by divergence."""
    cells = counts.kept.groupBy("lang", "source", "n", "lang_n").agg(F.count("*").alias("m")).join(counts.groups, ["lang", "source"])
    p, q = _share(F.col("n"), F.col("total"), F.col("terms")), _share(F.col("lang_n"), F.col("lang_total"), F.col("terms"))
    cells = cells.select("lang", "source", "n", "lang_n", "m", p.alias("p"), q.alias("q")).filter("p > q").withColumn("value", _divergence(F.col("p"), F.col("q")))
    cells = materialise(cells.select("lang", "source", "n", "lang_n", "m", "value"), "cells")
    # every value holds a term, so no more values than wanted terms can matter
    falling = Window.partitionBy("lang", "source").orderBy(F.col("value").desc())
    values = cells.groupBy("lang", "source", "value").agg(F.sum("m").alias("m")).withColumn("place", F.row_number().over(falling)).filter(F.col("place") <= rule.top)
    above = F.coalesce(F.sum("m").over(falling.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    heads = values.withColumn("above", above).filter(F.col("above") < rule.top).select("lang", "source", "value", "above")
    reached = cells.join(heads, ["lang", "source", "value"]).select("lang", "source", "n", "lang_n", "value", "above")
    listed = counts.kept.join(reached, ["lang", "source", "n", "lang_n"])
    in_value = Window.partitionBy("lang", "source", "value").orderBy("term")
    listed = listed.withColumn("place", F.row_number().over(in_value)).filter(F.col("place") <= rule.top)
    ranked = listed.withColumn("rank", (F.col("above") + F.col("place")).cast("int")).filter(F.col("rank") <= rule.top)
    return ranked.select("lang", "source", F.col("term").alias("item"), "value", "rank")


def _tile(key: tuple, rows: pa.Table, size: int) -> pa.Table:
    """Sums of f over a run of terms, per pair of a source of block a and a later one of block b.

    Rows are (term, place, p); those without a term give what a source's share is where it lacks a term.
    """
    lang, a, b = (x.as_py() for x in key[:3])
    rows = rows.combine_chunks()
    place, p = (rows.column(c).to_numpy() for c in ("place", "p"))
    head = rows.column("term").is_null().to_numpy()
    coded = rows.column("term").filter(pc.is_valid(rows.column("term"))).combine_chunks().dictionary_encode()
    if isinstance(coded, pa.ChunkedArray):
        coded = coded.combine_chunks()
    at, terms = coded.indices.to_numpy(), len(coded.dictionary)

    def shares(block: int) -> np.ndarray:
        own = place // size == block
        default = np.zeros(int((head & own).sum()), np.int64)
        default[place[head & own] - block * size] = p[head & own]
        out = np.tile(default, (terms, 1))
        there = own[~head]
        out[at[there], place[~head][there] - block * size] = p[~head][there]
        return out

    left = shares(a)
    right = left if a == b else shares(b)
    value = np.stack([_divergences(left[:, [k]], right).sum(axis=0) for k in range(left.shape[1])])
    x, y = np.meshgrid(a * size + np.arange(left.shape[1]), b * size + np.arange(right.shape[1]), indexing="ij")
    later = x < y
    n = int(later.sum())
    return pa.table({"lang": pa.array([lang] * n, pa.string()), "x": x[later], "y": y[later], "value": value[later], "seen": np.full(n, terms, np.int64)})


def pair_divergences(counts: Counts, rule: DivergenceRule = DivergenceRule()) -> DataFrame:
    """lang, source, item (each other source of the language), value summed over all kept terms, rank."""
    by_name = Window.partitionBy("lang").orderBy("source")
    p0 = F.when(F.col("terms") > 0, _share(F.lit(0), F.col("total"), F.col("terms"))).otherwise(0)
    places = counts.groups.withColumn("place", (F.row_number().over(by_name) - 1).cast("long")).withColumn("block", F.expr(f"place div {rule.block}"))
    places = materialise(places.withColumn("p0", p0).withColumn("runs", F.expr(f"(terms + {rule.run_terms - 1}) div {rule.run_terms}")), "source-places")
    shares = counts.kept.join(places, ["lang", "source"])
    shares = shares.select("lang", "term", "block", "place", _share(F.col("n"), F.col("total"), F.col("terms")).alias("p"), F.pmod(F.xxhash64("term"), "runs").alias("run"))
    default = places.select("lang", F.lit(None).cast("string").alias("term"), "block", "place", F.col("p0").alias("p"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("runs") - 1)).alias("run"), "runs")
    blocks = places.select("lang", F.col("block").alias("other")).distinct()
    met = shares.unionByName(default.filter("runs > 0").drop("runs")).join(blocks, "lang")
    met = met.select("lang", F.least("block", "other").alias("a"), F.greatest("block", "other").alias("b"), "run", "term", "place", "p")
    sums = met.groupBy("lang", "a", "b", "run").applyInArrow(lambda key, part: _tile(key, part, rule.block), "lang string, x long, y long, value long, seen long")
    sums = sums.groupBy("lang", "x", "y").agg(F.sum("value").alias("value"), F.sum("seen").alias("seen"))
    one = places.select("lang", F.col("place").alias("x"), F.col("source").alias("sx"), F.col("p0").alias("px"), "terms")
    two = places.select("lang", F.col("place").alias("y"), F.col("source").alias("sy"), F.col("p0").alias("py"))
    # every two sources of a language are rows of the result
    pairs = one.join(two, "lang").filter("x < y").join(sums, ["lang", "x", "y"], "left").na.fill(0, ["value", "seen"])
    rest = F.when(F.col("terms") > 0, (F.col("terms") - F.col("seen")) * _divergence(F.col("px"), F.col("py"))).otherwise(0)
    pairs = pairs.withColumn("value", F.col("value") + rest)
    both = F.explode(F.array(F.struct(F.col("sx").alias("source"), F.col("sy").alias("item")), F.struct(F.col("sy").alias("source"), F.col("sx").alias("item"))))
    listed = pairs.select("lang", "value", both.alias("s")).select("lang", "s.source", "s.item", "value")
    return listed.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")))


def audit(docs: DataFrame, rule: DivergenceRule = DivergenceRule(), lang_col="lang", source_col="source", text_col="text") -> DataFrame:
    """lang, source, part, item, value, rank.

    Part ``pair`` has each other source of the language, part ``term`` the first ``rule.top`` terms of which the
    source has more than its language; both from 1 by falling value, equal values by item in UTF-8 order. Null
    texts, languages and sources are read as ''. Every row is a document, so a repeated row counts again. A
    language without kept terms has pairs of value 0 and no terms; an empty table has no rows. Other columns are
    not read.
    """
    counts = count_terms(docs, rule, lang_col, source_col, text_col)
    part = lambda df, name: df.select("lang", "source", F.lit(name).alias("part"), "item", "value", F.col("rank").cast("int").alias("rank"))
    return part(pair_divergences(counts, rule), "pair").unionByName(part(top_terms(counts, rule), "term"))
