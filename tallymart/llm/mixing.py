"""Mixing sources to target weights, with DataFrame operations only.

Every document has a hash. For each source the documents with a hash below a threshold make up the
budget. The threshold comes from histograms: tokens are summed by source and hash bucket, the bucket in
which the budget runs out is cut into finer buckets, and so on until a bucket is one hash value. Nothing
is sorted, and what is aggregated is one row per source and bucket whatever a source holds.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallymart.llm.shared import fresh, word_count
from tallymart.session import materialise, tune

HASH_BITS = 60


@dataclass(frozen=True)
class MixRule:
    """``weights`` repeat over the sources in code point order; no source exceeds ``most_repeats`` times its size."""

    weights: tuple[int, ...] = (1, 2, 3)
    most_repeats: int = 3
    level_bits: int = 15


def _hash(doc_id):
    """60 bits of the id's MD5: the same in every run and in any engine. A null id has hash 0."""
    digits = F.substring(F.md5(doc_id.cast("string")), 1, HASH_BITS // 4)
    return F.coalesce(F.conv(digits, 16, 10).cast("long"), F.lit(0))


def source_targets(sizes: DataFrame, rule: MixRule = MixRule()) -> DataFrame:
    """Per source its size, target, whole repeats and the words left over for a part of the documents.

    Targets are ``least(most_repeats * size, level * weight)`` with the one level at which they sum up to all
    words; that is where resharing the excess by weight ends. The level is the largest of
    ``(total - caps before) / (weights from here)`` in the order of cap per weight.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    # windows over one row per source
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weights = F.array(*map(F.lit, rule.weights))
    ranked = sources.withColumn("place", F.row_number().over(by_name)).select(
        "source",
        "source_size",
        "place",
        F.element_at(weights, ((F.col("place") - 1) % len(rule.weights) + 1).cast("int")).cast("long").alias("weight"),
        (F.lit(rule.most_repeats) * F.col("source_size")).alias("cap"),
    )
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), "place")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    onwards = by_ratio.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    level = (
        F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    ) / F.sum("weight").over(onwards)
    filled = ranked.withColumn("at_level", level).withColumn(
        "target", F.least(F.col("cap").cast("double"), F.max("at_level").over(everything) * F.col("weight"))
    )
    repeats = F.when(
        F.col("source_size") > 0,
        F.least(F.lit(rule.most_repeats), F.floor(F.col("target") / F.col("source_size"))),
    ).otherwise(F.lit(0))
    return filled.select("source", "source_size", "target", repeats.cast("long").alias("repeats")).withColumn(
        "rest", F.col("target") - F.col("repeats") * F.col("source_size")
    )


def _refine(hashed: DataFrame, found: DataFrame, shift: int, width: int) -> DataFrame:
    """One level: histogram of the open bucket ``[threshold, threshold + 2**width)`` of every source."""
    inside = hashed.join(found.filter("open").withColumnRenamed("source", "to_source"), F.col("source").eqNullSafe(F.col("to_source"))).filter(
        (F.col("hash") >= F.col("threshold")) & (F.col("hash") < F.col("threshold") + F.lit(1 << width))
    )
    bucket = F.shiftright(F.col("hash") - F.col("threshold"), shift)
    sums = inside.groupBy("source", "threshold", "rest", bucket.alias("bucket")).agg(F.sum("size").alias("words"))
    upto = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    over = (
        sums.withColumn("upto", F.sum("words").over(upto))
        .filter("upto > rest")
        .groupBy("source")
        .agg(F.min(F.struct("bucket", "upto", "words", "threshold", "rest")).alias("edge"))
    )
    edge = over.select(
        F.col("source").alias("edge_source"),
        (F.col("edge.threshold") + F.shiftleft(F.col("edge.bucket"), shift)).alias("edge_threshold"),
        (F.col("edge.rest") - (F.col("edge.upto") - F.col("edge.words"))).alias("edge_rest"),
        F.lit(True).alias("met"),
    )
    return found.join(edge, F.col("source").eqNullSafe(F.col("edge_source")), "left").select(
        "source",
        "source_size",
        "target",
        "repeats",
        # a source whose documents all fit has no edge: everything lies below the end of the range
        F.when(F.col("met"), F.col("edge_threshold")).when(F.col("open"), F.col("threshold") + F.lit(1 << width)).otherwise(F.col("threshold")).alias("threshold"),
        F.when(F.col("met"), F.col("edge_rest")).otherwise(F.col("rest")).alias("rest"),
        F.coalesce(F.col("met"), F.lit(False)).alias("open"),
    )


def fit(docs: DataFrame, rule: MixRule = MixRule(), id_col="doc_id", text_col="text", source_col="source") -> tuple[DataFrame, DataFrame]:
    """The sized documents (doc_id, source, size, hash) and per source what the mix takes, both stored.

    A document is taken ``repeats`` times, and once more if its hash is below ``threshold``.
    """
    tune(docs.sparkSession)
    hashed = materialise(
        docs.select(
            F.col(id_col).alias("doc_id"),
            F.col(source_col).alias("source"),
            word_count(F.col(text_col)).alias("size"),
            _hash(F.col(id_col)).alias("hash"),
        ),
        "mix-sizes",
    )
    start = source_targets(hashed, rule).withColumn("threshold", F.lit(0).cast("long")).withColumn("open", F.lit(True))
    found, width = materialise(start, "mix-level"), HASH_BITS
    while width > 0:
        shift = max(0, width - rule.level_bits)
        found, width = materialise(_refine(hashed, found, shift, width), "mix-level"), shift
    return hashed, found


def _with_copies(docs: DataFrame, found: DataFrame, source, doc_hash, name: str) -> DataFrame:
    per_source = found.select(*(F.col(c).alias(f"{name}_{c}") for c in found.columns))
    copies = F.col(f"{name}_repeats") + F.when(doc_hash < F.col(f"{name}_threshold"), 1).otherwise(0)
    return docs.join(per_source, source.eqNullSafe(F.col(f"{name}_source"))).withColumn(name, copies.cast("long"))


def mix_report(docs: DataFrame, rule: MixRule = MixRule(), **columns: str) -> DataFrame:
    """Per document: doc_id, size, source_size, target, taken, copies.

    A null text has size 0, a null source is a source of its own after all others. Rows with the same id have
    the same hash and are taken alike. An empty table gives no rows. A source's taken words fall short of its
    target by less than the documents at its threshold.
    """
    hashed, found = fit(docs, rule, **columns)
    rows = _with_copies(hashed, found, F.col("source"), F.col("hash"), "copies")
    return rows.select(
        "doc_id",
        "size",
        F.col("copies_source_size").alias("source_size"),
        F.col("copies_target").alias("target"),
        (F.col("size") * F.col("copies")).alias("taken"),
        "copies",
        "source",
    )


def mix(docs: DataFrame, rule: MixRule = MixRule(), id_col="doc_id", text_col="text", source_col="source") -> DataFrame:
    """The mixed documents: every row as often as the mix takes it, with the columns of ``docs``."""
    _, found = fit(docs, rule, id_col, text_col, source_col)
    copies = fresh(docs, "mix_copies")
    rows = _with_copies(docs, found, F.col(source_col), _hash(F.col(id_col)), copies)
    once_each = F.explode(F.array_repeat(F.lit(0), F.col(copies).cast("int")))
    return rows.select(*(F.col(f"`{c}`") for c in docs.columns), once_each.alias(copies)).drop(copies)
