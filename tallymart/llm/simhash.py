"""Document fingerprints: SimHash, and all near fingerprints through permuted block tables.

A term (three words in a row, or all words of a shorter text) has a hash; each of its bits votes up or
down with the term's weight, its number of occurrences, and the signs of the sums are the fingerprint.
The share of bits that differ between two fingerprints grows with the angle of the texts' term vectors.

To find fingerprints within a Hamming radius, the bits are cut into blocks. Two fingerprints that differ in
at most ``radius`` bits agree in at least ``blocks - radius`` blocks, so one table per choice of that many
blocks, keyed by their bits, holds every such pair; the exact distance decides.

Real near copies lie farther apart than copies with one edit. For these, each of ``WIDE_BLOCKS`` blocks is one
table, and a query also asks for the keys with one bit of its block changed: two fingerprints that differ in
fewer than twice as many bits as there are blocks differ in at most one bit of some block.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymart.llm.shared import id_and_text, mix64, slices, window_hashes, word_hashes
from tallymart.session import materialise, tune

BITS = 128
WIDE_BLOCKS = 8
WIDE_RADIUS = 2 * WIDE_BLOCKS - 1
STEP = 1 << 18  # terms whose bits are unpacked at a time


@dataclass(frozen=True)
class BlockTables:
    """Radius of the search and the blocks that the bits are cut into, more than the radius."""

    radius: int = 3
    blocks: int = 5

    def cuts(self) -> list[tuple[int, int]]:
        """Hexadecimal digits (start, length) of each block."""
        digits = BITS // 4
        edges = [digits * k // self.blocks for k in range(self.blocks + 1)]
        return [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]

    def keys(self, fingerprint: Column) -> list[Column]:
        """The key of each table: its number and the blocks it puts first."""
        parts = [F.substring(fingerprint, a + 1, n) for a, n in self.cuts()]
        chosen = combinations(range(self.blocks), self.blocks - self.radius)
        return [F.struct(F.lit(t).alias("t"), F.concat(*(parts[b] for b in some)).alias("key")) for t, some in enumerate(chosen)]


def fingerprints(texts: pa.Array, width: int = 3) -> np.ndarray:
    """A row of ``BITS // 8`` bytes per text; zeros for a text without words."""
    n = len(texts)
    term, owner = window_hashes(*word_hashes(texts), width)
    terms = np.bincount(owner, minlength=n)
    term_first = np.r_[0, np.cumsum(terms)]
    out = np.zeros((n, BITS // 8), np.uint8)
    filled = np.flatnonzero(terms)
    for lane in range(BITS // 64):
        bits = mix64(term + np.uint64((lane + 1) * 0xD1B54A32D192ED03 % 2**64)).astype("<u8").view(np.uint8).reshape(-1, 8)
        votes = np.zeros((n, 64), np.int64)
        for a in range(0, len(term), STEP):
            # a byte per bit, added eight at a time in runs too short for a byte to overflow
            part = np.unpackbits(bits[a : a + STEP], axis=1).view(np.uint64)
            own, place = owner[a : a + STEP], np.arange(a, a + len(part)) - term_first[owner[a : a + STEP]]
            at = np.flatnonzero(np.r_[True, own[1:] != own[:-1]] | (place % 255 == 0))
            np.add.at(votes, own[at], np.add.reduceat(part, at, axis=0).view(np.uint8))
        up = 2 * votes[filled] > terms[filled, None]
        out[filled, lane * 8 : lane * 8 + 8] = np.packbits(up, axis=1)
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of the angle that the share of differing bits stands for; 0 for a right angle or more."""
    differ = np.bitwise_count(a ^ b).sum(1)
    return np.where(differ == 0, 1.0, np.maximum(0.0, np.cos(np.pi * differ / BITS)))


def _hex(rows: np.ndarray) -> pa.Array:
    return pa.array([r.tobytes().hex() for r in rows], pa.string())


def edit(text: str, following: str) -> str:
    """The last half of the code points replaced by as many of the first of ``following``, or by all it has."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def with_following(docs: DataFrame, n_ranges: int | None = None) -> DataFrame:
    """``docs`` (doc_id, text) in ranges of ascending id, each range closed by the first row of the next.

    Rows get ``range`` and ``own``: 0 for a row of the range, 1 for the row that only follows its last
    one; after the last range that is the very first row. One shuffle of the texts; sorted by
    (range, own, doc_id, text) within partitions, a null id first.
    """
    spark = docs.sparkSession
    n = n_ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ids = docs.select("doc_id")
    cuts = ids.agg(F.percentile_approx("doc_id", [k / n for k in range(1, n)], 100 * n).alias("c")).first()["c"] if n > 1 else None
    edges = F.array(*(F.lit(c).cast("long") for c in sorted(set(cuts or []))))
    # the range is the number of edges below the id: ids of a range are neighbours, equal ids share one
    place = F.coalesce(F.size(F.filter(edges, lambda e: e < F.col("doc_id"))), F.lit(0)).cast("int") if cuts else F.lit(0)
    ranged = docs.withColumn("range", place).withColumn("own", F.lit(0))
    # one row per range: its smallest id, and the smallest text of that id
    least = ranged.groupBy("range").agg(F.min(F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id")).alias("least"))
    heads = ranged.join(F.broadcast(least.withColumnRenamed("range", "to")), (F.col("range") == F.col("to")) & F.col("doc_id").eqNullSafe(F.col("least.doc_id")))
    heads = materialise(heads.groupBy("range", "doc_id").agg(F.min("text").alias("text")), "range-heads")
    # windows over one row per range
    previous = Window.orderBy("range")
    back = F.coalesce(F.lag("range").over(previous), F.max("range").over(Window.partitionBy()))
    closing = heads.select("doc_id", "text", back.alias("range"), F.lit(1).alias("own"))
    return ranged.unionByName(closing).repartition(n, "range").sortWithinPartitions("range", "own", F.col("doc_id").asc_nulls_first(), "text")


REPORT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def fingerprint_pairs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row its fingerprint, its edited text's, and the likeness to that and to the next row's fingerprint.

    The next row is that with the next larger id (repeated ids follow by text), after the last the first; of a
    single row it is itself. A null or empty text has no terms and the fingerprint zero.
    """

    def report(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last row so far, which waits for the one that follows it
        for part in slices(batches, "text", 2 << 20):
            rows = part if held is None else pa.concat_batches([held, part])
            held = rows.slice(rows.num_rows - 1)
            if rows.num_rows > 1:
                yield from _pairs(rows)

    def _pairs(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        text = [t or "" for t in rows.column("text").to_pylist()]
        own = rows.column("own").to_numpy()[:-1] == 0
        edited = [edit(a, b) if o else "" for a, b, o in zip(text, text[1:], own, strict=False)]
        both = fingerprints(pa.array(text + edited, pa.string()))
        prints, changed = both[: len(text)], both[len(text) :]
        found = pa.RecordBatch.from_arrays(
            [
                rows.column("doc_id").slice(0, rows.num_rows - 1),
                pa.array([len(t) for t in text[:-1]], pa.int64()),
                pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited], pa.string()),
                _hex(prints[:-1]),
                _hex(changed),
                pa.array(likeness(prints[:-1], changed)),
                pa.array(likeness(prints[:-1], prints[1:])),
            ],
            ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
        )
        yield found.filter(pa.array(own))

    return with_following(id_and_text(docs, id_col, text_col)).mapInArrow(report, REPORT)


def distance(a: Column, b: Column) -> Column:
    """Hamming distance of two fingerprints in hexadecimal."""
    words = range(0, BITS // 4, 8)
    return sum(F.bit_count(F.conv(F.substring(a, k + 1, 8), 16, 10).cast("long").bitwiseXOR(F.conv(F.substring(b, k + 1, 8), 16, 10).cast("long"))) for k in words)


def near_counts(prints: DataFrame, queries: Column, tables: BlockTables = BlockTables()) -> DataFrame:
    """Per document that ``queries`` picks: doc_id and n_near, the other rows of ``prints`` within the radius.

    Equal fingerprints are one entry with a count on either side, so a group of copies costs one row per table.
    """
    tune(prints.sparkSession)
    classes = prints.groupBy("fingerprint").agg(F.count("*").alias("n"), F.max(queries.cast("int")).alias("asked"))
    classes = materialise(classes, "print-classes")
    asked = classes.filter("asked = 1").select(F.col("fingerprint").alias("q"), F.explode(F.array(*tables.keys(F.col("fingerprint")))).alias("k"))
    entries = classes.select("fingerprint", "n", F.explode(F.array(*tables.keys(F.col("fingerprint")))).alias("k"))
    pairs = asked.join(entries, "k").filter(distance(F.col("q"), F.col("fingerprint")) <= tables.radius)
    # a pair may meet in several tables
    near = pairs.select("q", "fingerprint", "n").distinct().groupBy("q").agg(F.sum("n").alias("n"))
    picked = prints.filter(queries).select("doc_id", "fingerprint")
    return picked.join(near, picked["fingerprint"] == near["q"]).select("doc_id", (F.col("n") - 1).alias("n_near"))


def near_classes(prints: DataFrame, queries: Column) -> DataFrame:
    """Per fingerprint q of a document that ``queries`` picks: the fingerprints within ``WIDE_RADIUS``, q among them.

    Columns q, fingerprint, distance and n, the number of rows of ``prints`` that have the fingerprint.
    """
    tune(prints.sparkSession)
    width = BITS // WIDE_BLOCKS
    classes = prints.groupBy("fingerprint").agg(F.count("*").alias("n"), F.max(queries.cast("int")).alias("asked"))
    block = [F.conv(F.substring("fingerprint", width // 4 * k + 1, width // 4), 16, 10).cast("int") for k in range(WIDE_BLOCKS)]
    classes = materialise(classes.select("*", *(b.alias(f"b{k}") for k, b in enumerate(block))), "wide-classes")
    theirs = [f"b{k}" for k in range(WIDE_BLOCKS)]
    ours = [f"q{k}" for k in range(WIDE_BLOCKS)]
    asked = classes.filter("asked = 1").select(F.col("fingerprint").alias("q"), *(F.col(b).alias(q) for b, q in zip(theirs, ours, strict=True)))
    asked = asked.select("*", F.posexplode(F.array(*ours)).alias("t", "block"))
    asked = asked.select("q", *ours, "t", F.explode(F.array(*(F.lit(m) for m in (0, *(1 << k for k in range(width)))))).alias("m"), "block")
    asked = asked.withColumn("key", F.col("block").bitwiseXOR(F.col("m"))).drop("m", "block")
    entries = classes.select("fingerprint", "n", *theirs, F.posexplode(F.array(*theirs)).alias("t", "key"))
    differ = [F.bit_count(F.col(b).bitwiseXOR(F.col(q))) for b, q in zip(theirs, ours, strict=True)]
    # a pair may meet in several tables and counts in the first
    first = F.coalesce(*(F.when(d <= 1, k) for k, d in enumerate(differ)))
    met = asked.join(entries, ["t", "key"]).filter(F.col("t") == first)
    return met.select("q", "fingerprint", sum(differ[1:], differ[0]).cast("int").alias("distance"), "n").filter(F.col("distance") <= WIDE_RADIUS)


def fingerprint_report(docs: DataFrame, every: int = 20, tables: BlockTables = BlockTables(), **columns: str) -> DataFrame:
    """``fingerprint_pairs`` with ``n_near`` and ``near`` for every id divisible by ``every``.

    ``n_near`` counts the other documents within the radius of ``tables``. ``near`` lists the fingerprints within
    ``WIDE_RADIUS``, nearest first, each with its distance and its number of documents, the row's own included;
    the documents of a class are the rows with its fingerprint.
    """
    prints = materialise(fingerprint_pairs(docs, **columns), "prints")
    asked = F.coalesce(F.col("doc_id") % every == 0, F.lit(False))
    near = near_counts(prints.select("doc_id", "fingerprint"), asked, tables).groupBy("doc_id").agg(F.max("n_near").alias("n_near"))
    pairs = near_classes(prints.select("doc_id", "fingerprint"), asked)
    lists = pairs.groupBy("q").agg(F.sort_array(F.collect_list(F.struct("distance", "fingerprint", F.col("n").alias("n_docs")))).alias("near"))
    picked = prints.filter(asked).select(F.col("doc_id").alias("id"), F.col("fingerprint").alias("own_print")).distinct()
    wide = picked.join(lists, picked["own_print"] == lists["q"]).drop("q")
    counted = prints.join(near, "doc_id", "left")
    return counted.join(wide, (counted["doc_id"] == wide["id"]) & (counted["fingerprint"] == wide["own_print"]), "left").drop("id", "own_print")
