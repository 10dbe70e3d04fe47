"""Near copies by SetSketch registers.

A sketch has one register per hash function: the least of the exponential values of a set's elements, on an
exponentially spaced scale and truncated to 16 bits. The sketch of a union is the larger of both registers, place by
place, and two sets agree in a register nearly as often as they share elements.

Registers are cut into bands; sets that agree in all registers of a band are candidates. How many registers are
larger, smaller and equal, together with the known sizes, gives the likelihood of every similarity; candidates
whose best similarity below the limit is beyond doubt are dropped, all others are verified on their whole sets.

Sets that are equal are one. Links are needed up to their components, so in every round each band value links its
sets to one pivot, and sets of one component need no further links. After the first round the sets of a family are kept as what they
differ in from its core: whether two link depends on their common differences only, and a set that shares too few differences with
others has no partner. Rounds go on with other pivots until one finds nothing or little is left; only then pairs of
different components that share a rare difference are listed, filtered by sizes and likelihood, and verified.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymart.llm.shared import fresh, id_and_text, mix64, release_shuffles, slices, window_hashes, word_hashes
from tallymart.session import materialise, tune

HASH_RUN = 1 << 19  # bytes whose hashes are in memory at a time
CHUNK = 1 << 14  # hashes that stay in a core's cache while all registers are worked out


@dataclass(frozen=True)
class SketchRule:
    """Sets of ``width`` words link at ``100 * intersection >= percent * union``.

    ``bands`` of ``rows`` registers: sets at the limit agree in no band with a probability of about
    (1 - (percent / 100) ** rows) ** bands, 3e-7 here. ``base`` and ``rate`` are the spacing of the scale and the rate of its
    exponential values; ``doubt`` is the ratio of likelihoods (natural logarithm) that drops a candidate.
    """

    width: int = 3
    percent: int = 85
    bands: int = 32
    rows: int = 6
    base: float = 1.001
    rate: float = 20.0
    doubt: float = 20.0

    @property
    def registers(self) -> int:
        return self.bands * self.rows


def shingle_sets(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of an array of texts as 64-bit hashes, sorted, and where each text's begin."""
    hashes, owner = window_hashes(*word_hashes(texts, lower=True), width)
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    once = np.r_[True, (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])][: len(hashes)]
    return hashes[once], np.searchsorted(owner[once], np.arange(len(texts) + 1))


def _signatures(hashes: np.ndarray, first: np.ndarray) -> list[np.ndarray]:
    """Two numbers of 64 bits that equal sets share: sums of their mixed hashes."""
    sums = [np.r_[np.uint64(0), np.cumsum(mix64(hashes ^ np.uint64(salt)), dtype=np.uint64)] for salt in (0x452821E638D01377, 0xBE5466CF34E90C6C)]
    return [(x[first[1:]] - x[first[:-1]]).view(np.int64) for x in sums]


def sketches(hashes: np.ndarray, first: np.ndarray, rule: SketchRule) -> np.ndarray:
    """Registers of each set of 64-bit hashes, one row a set; an empty set has zeros."""
    least = np.full((rule.registers, len(first) - 1), np.iinfo(np.uint64).max, np.uint64)
    salts = mix64(np.arange(1, rule.registers + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    sizes = np.diff(first)
    x, y = np.empty(CHUNK, np.uint64), np.empty(CHUNK, np.uint64)
    for a in range(0, len(hashes), CHUNK):
        part = hashes[a : a + CHUNK]
        # the sets that begin before the end of the chunk and end after its start
        low, high = int(np.searchsorted(first, a, side="right")) - 1, int(np.searchsorted(first, a + len(part), side="left"))
        sets = low + np.flatnonzero(sizes[low:high] > 0)
        starts = np.maximum(first[sets], a) - a
        u, v = x[: len(part)], y[: len(part)]
        for k in range(rule.registers):
            np.bitwise_xor(part, salts[k], out=u)
            np.multiply(u, np.uint64(0xBF58476D1CE4E5B9), out=u)
            np.right_shift(u, np.uint64(29), out=v)
            np.bitwise_xor(u, v, out=u)
            np.multiply(u, np.uint64(0x94D049BB133111EB), out=u)
            found = np.minimum.reduceat(u, starts)
            least[k, sets] = np.minimum(least[k, sets], found)
    uniform = (least.T.astype(np.float64) + 0.5) / 2.0**64
    with np.errstate(divide="ignore"):
        value = -np.log1p(-np.minimum(uniform, 1 - 2.0**-53)) / rule.rate
        scale = np.floor(1 - np.log(value) / np.log(rule.base))
    registers = np.clip(scale, 0, 65_535).astype(np.uint16)
    registers[sizes == 0] = 0
    return registers


def merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The sketch of the union of two sets."""
    return np.maximum(a, b)


def log_likelihood(larger: np.ndarray, smaller: np.ndarray, equal: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, similarity: np.ndarray, base: float) -> np.ndarray:
    """Of pairs with so many larger, smaller and equal registers and known sizes, at a similarity."""
    u, v = n_a / (n_a + n_b), n_b / (n_a + n_b)
    step = (base - 1) / base

    def odds(x: np.ndarray) -> np.ndarray:
        return -np.log1p(-np.maximum(x, 1e-12) * step) / np.log(base)

    up, down = odds(u - v * similarity), odds(v - u * similarity)
    same = np.maximum(1 - up - down, 1e-300)
    return larger * np.log(up) + smaller * np.log(down) + equal * np.log(same)


def beyond_doubt(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, rule: SketchRule) -> np.ndarray:
    """Whether pairs of sketches (one a row) are less similar than the limit beyond doubt."""
    larger, smaller = (a > b).sum(axis=1)[:, None], (a < b).sum(axis=1)[:, None]
    equal = a.shape[1] - larger - smaller
    n_a, n_b = n_a.astype(float)[:, None], n_b.astype(float)[:, None]
    limit = np.minimum(rule.percent / 100, np.minimum(n_a / n_b, n_b / n_a))
    below = limit * np.linspace(0, 1, 60)[None, :]
    found = log_likelihood(larger, smaller, equal, n_a, n_b, below, rule.base)
    return found.max(axis=1) - found[:, -1] > rule.doubt


def _describe(rows: DataFrame, rule: SketchRule) -> DataFrame:
    """Per row of ``rows`` (doc_id, text): doc_id, n, s1 and s2 (which equal sets share), t (a hash of the text), sketch."""

    def describe(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", HASH_RUN):
            hashes, first = shingle_sets(part.column("text"), rule.width)
            signs = [pa.array(x) for x in _signatures(hashes, first)]
            registers = sketches(hashes, first, rule)
            packed = pa.array([row.tobytes() for row in registers], pa.binary())
            columns = [part.column("doc_id"), pa.array(np.diff(first)), *signs, part.column("t"), packed]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "s1", "s2", "t", "sketch"])

    return rows.withColumn("t", F.xxhash64("text")).mapInArrow(describe, "doc_id long, n long, s1 long, s2 long, t long, sketch binary")


def _registers(column: pa.Array, rule: SketchRule) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u2").reshape(-1, rule.registers)


def _bands(sets: DataFrame, rule: SketchRule) -> DataFrame:
    """doc and a 64-bit key of each band of the sketches of ``sets`` (doc, sketch)."""

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(k, 2_000) for b in batches for k in range(0, b.num_rows, 2_000)):
            registers = _registers(batch.column("sketch"), rule).reshape(batch.num_rows, rule.bands, rule.rows)
            key = np.broadcast_to(np.arange(rule.bands, dtype=np.uint64), (batch.num_rows, rule.bands)).copy()
            for k in range(rule.rows):
                key = mix64(key * np.uint64(0x9E3779B97F4A7C15) + registers[:, :, k].astype(np.uint64) + np.uint64(1))
            doc = np.repeat(batch.column("doc").to_numpy(), rule.bands)
            yield pa.RecordBatch.from_arrays([pa.array(key.ravel().view(np.int64)), pa.array(doc)], ["key", "doc"])

    return sets.select("doc", "sketch").mapInArrow(cut, "key long, doc long")


def _likely(pairs: DataFrame, sets: DataFrame, rule: SketchRule) -> DataFrame:
    """The pairs (a, b) that may reach the limit, by sizes and by the likelihood of their registers."""
    side = lambda x: sets.select(F.col("doc").alias(x), F.col("n").alias(f"n{x}"), F.col("sketch").alias(f"k{x}"))

    def judge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(k, 2_000) for b in batches for k in range(0, b.num_rows, 2_000)):
            a, b = (_registers(batch.column(c), rule) for c in ("ka", "kb"))
            n_a, n_b = (batch.column(c).to_numpy() for c in ("na", "nb"))
            yield batch.select(["a", "b"]).filter(pa.array(~beyond_doubt(a, b, n_a, n_b, rule)))

    known = pairs.join(side("a"), "a").join(side("b"), "b").filter(F.least("na", "nb") * 100 >= F.greatest("na", "nb") * rule.percent)
    return known.select("a", "b", "na", "nb", "ka", "kb").mapInArrow(judge, "a long, b long")


def _whole_sets(sets: DataFrame, rows: DataFrame, rule: SketchRule) -> DataFrame:
    """doc and elements (packed) of ``sets`` (doc, s1, s2, t) from ``rows`` (doc_id, text), stored."""

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", HASH_RUN):
            hashes, first = shingle_sets(part.column("text"), rule.width)
            packed = [hashes[a:b].tobytes() for a, b in zip(first, first[1:], strict=False)]
            # of rows that share an id, the one with the chosen set
            right = np.logical_and(*(x == part.column(c).to_numpy() for x, c in zip(_signatures(hashes, first), ("s1", "s2"), strict=True)))
            yield pa.RecordBatch.from_arrays([part.column("doc"), pa.array(packed, pa.binary())], ["doc", "elements"]).filter(pa.array(right))

    # equal texts of an id become one where the join has brought them together, so that no further shuffle is needed
    wanted = rows.withColumnRenamed("doc_id", "doc").withColumn("t", F.xxhash64("text")).join(sets.select("doc", "s1", "s2", "t"), ["doc", "t"])
    wanted = wanted.dropDuplicates(["doc", "t"])
    return materialise(wanted.select("doc", "s1", "s2", "text").mapInArrow(pack, "doc long, elements binary"), "whole-sets")


def _verified(pairs: DataFrame, whole: DataFrame, rule: SketchRule) -> DataFrame:
    """The pairs (a, b) whose whole sets (doc, elements) link, stored."""

    def verify(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for ta, tb in zip(batch.column("ta"), batch.column("tb"), strict=True):
                x, y = np.frombuffer(ta.as_buffer(), "<u8"), np.frombuffer(tb.as_buffer(), "<u8")
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= rule.percent * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    side = lambda x: whole.select(F.col("doc").alias(x), F.col("elements").alias(f"t{x}"))
    return materialise(pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "ta", "tb").mapInArrow(verify, "a long, b long"), "sketch-links")


def _components(links: DataFrame) -> DataFrame:
    """Per node of ``links`` (a, b): node and comp, the least node of its component; stored.

    Every component hooks to its least neighbour, chains are followed to their end, and links between
    components are carried over until there are none.
    """
    spark = links.sparkSession
    open_ = materialise(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "open-links")
    labels = materialise(open_.select(F.explode(F.array("a", "b")).alias("node")).distinct().withColumn("comp", F.col("node")), "labels")
    while not open_.isEmpty():
        to = open_.groupBy(F.col("b").alias("x")).agg(F.min("a").alias("to"))
        roots = open_.select(F.col("a").alias("x")).distinct().join(to, "x", "left_anti").withColumn("to", F.col("x"))
        to = materialise(to.unionByName(roots), "hooks")
        while True:
            ahead = to.select(F.col("x").alias("to"), F.col("to").alias("end"))
            jumped = materialise(to.join(ahead, "to").select("x", "to", "end"), "jumps")
            to = jumped.select("x", F.col("end").alias("to"))
            if jumped.filter("to <> end").isEmpty():
                break
        labels = materialise(labels.join(to, labels["comp"] == to["x"], "left").select("node", F.coalesce("to", "comp").alias("comp")), "labels")
        end = lambda x, to=to: to.select(F.col("x").alias(x), F.col("to").alias(f"to_{x}"))
        moved = open_.join(end("a"), "a").join(end("b"), "b").filter("to_a <> to_b")
        open_ = materialise(moved.select(F.least("to_a", "to_b").alias("a"), F.greatest("to_a", "to_b").alias("b")).distinct(), "open-links")
        release_shuffles(spark)
    return labels


def _meeting(postings: DataFrame) -> DataFrame:
    """``postings`` (key, doc) of keys that several sets have, stored; one shuffle, as nearly all keys have one set."""
    return materialise(postings.withColumn("c", F.count("*").over(Window.partitionBy("key"))).filter("c > 1"), "meeting-postings")


def _one_of_each_bucket(postings: DataFrame) -> DataFrame:
    """``postings`` (key, doc, c) of keys that c sets have, one key for all that the same sets have."""
    sums = [F.sum(F.xxhash64("doc", F.lit(k)).cast("decimal(38,0)")).alias(f"s{k}") for k in (1, 2)]
    kept = postings.groupBy("key", "c").agg(*sums).groupBy("c", "s1", "s2").agg(F.min("key").alias("key")).select("key")
    return postings.join(kept, "key", "left_semi")


def _alike(one: str, two: str, rule: SketchRule) -> Column:
    """Whether sizes n allow the two to link."""
    n, k = (F.col(f"{x}n") for x in (one, two))
    return F.least(n, k) * 100 >= F.greatest(n, k) * rule.percent


def _may_share(one: str, two: str, rule: SketchRule) -> Column:
    """Whether the numbers m of shared differences are enough for the g of both, see ``_differences``."""
    return 2 * (100 + rule.percent) * F.least(f"{one}m", f"{two}m") >= F.col(f"{one}g") + F.col(f"{two}g")


def _differences(here: DataFrame, whole: DataFrame, rule: SketchRule) -> DataFrame:
    """Per set of ``here`` (key, doc, n, comp, central): doc, fam, g and d, how it differs from the core of its family; stored.

    A family is what buckets connect. Its core is the set that meets most others, with the elements added or left out that
    more than half of the family differ in; any core is right. d holds what only the set or only the core has. With
    g = (100 + percent) * |d| - (100 - percent) * n two sets link if and only if 2 * (100 + percent) * (common elements of
    their d) >= the sum of their g: what a family has in common is in no d, and what one set alone has is shared with none.
    """
    least = here.groupBy("key").agg(F.min("doc").alias("b"))
    meets = materialise(here.join(least, "key").filter("doc <> b").select(F.col("doc").alias("a"), "b").distinct(), "meets")
    families = _components(meets).select(F.col("node").alias("doc"), F.col("comp").alias("fam"))
    docs = materialise(here.groupBy("doc").agg(F.first("n").alias("n"), F.first("central").alias("central")).join(families, "doc"), "families")
    pivots = docs.groupBy("fam").agg(F.min(F.struct((-F.col("central")).alias("by"), "doc"))["doc"].alias("doc"), F.count("*").alias("size"))
    pivots = materialise(pivots, "family-pivots")
    held = materialise(whole.join(docs.select("doc", "fam", "n"), "doc"), "family-sets")
    cores = held.join(pivots.select("doc", "fam"), ["doc", "fam"]).select("fam", F.col("elements").alias("core"))

    def differ(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "elements", 1 << 20):
            sides = zip(*(part.column(c).to_pylist() for c in ("elements", "core")), strict=True)
            found = [np.setxor1d(np.frombuffer(x, "<i8"), np.frombuffer(y, "<i8"), assume_unique=True) for x, y in sides]
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("doc", "fam", "n")), pa.array(found, pa.list_(pa.int64()))], ["doc", "fam", "n", "d"])

    first = materialise(held.join(cores, "fam").select("doc", "fam", "n", "elements", "core").mapInArrow(differ, "doc long, fam long, n long, d array<long>"), "first-differences")
    common = first.select("fam", F.explode("d").alias("h")).groupBy("fam", "h").agg(F.count("*").alias("c"))
    common = common.join(pivots.select("fam", "size"), "fam").filter("2 * c > size").groupBy("fam").agg(F.collect_list("h").alias("common"))
    known = first.join(common, "fam", "left").withColumn("common", F.coalesce("common", F.array().cast("array<long>")))
    known = known.select("doc", "fam", "n", F.concat(F.array_except("d", "common"), F.array_except("common", "d")).alias("d"))
    return materialise(known.select("doc", "fam", ((100 + rule.percent) * F.size("d") - (100 - rule.percent) * F.col("n")).alias("g"), "d"), "differences")


def _near_core(differences: DataFrame) -> DataFrame:
    """Links (a, b) of sets so near to the core of their family that they link without a common difference, up to their components."""
    least = differences.groupBy("fam").agg(F.min(F.struct("g", "doc")).alias("x")).select("fam", F.col("x.g").alias("least"), F.col("x.doc").alias("b"))
    return differences.join(least, "fam").filter("g + least <= 0 AND doc <> b").select(F.least("doc", "b").alias("a"), F.greatest("doc", "b").alias("b"))


def _with_partner(differences: DataFrame, comps: DataFrame, rule: SketchRule) -> DataFrame:
    """Of ``differences`` (doc, fam, g, d) the sets that can have a partner of another component (doc, comp) by common differences.

    m is the number of differences that such a set has too. Of two that link, the one with the smaller g has m >= g / (100 + percent),
    and the other shares enough with the least such g. ``narrow`` (null for who cannot be the first of the two) and ``wide`` are
    their rarest shared differences, and one of them is common. Stored.
    """
    both = 100 + rule.percent
    named = differences.join(comps, "doc", "left").withColumn("comp", F.coalesce("comp", "doc"))
    held = named.select("doc", "fam", "comp", F.explode("d").alias("h"))
    often = held.groupBy("fam", "h").agg(F.count("*").alias("c"), F.min("comp").alias("low"), F.max("comp").alias("high")).filter("low < high")
    shared = held.join(often.select("fam", "h", "c"), ["fam", "h"]).groupBy("doc").agg(F.count("*").alias("m"), F.array_sort(F.collect_list(F.struct("c", "h"))).alias("x"))
    shared = differences.select("doc", "fam", "g").join(shared, "doc")
    shared = materialise(shared.select("doc", "fam", "g", "m", F.col("x.h").alias("d")), "shared-differences")
    least = shared.filter(F.col("m") * both >= F.col("g")).groupBy("fam").agg(F.min("g").alias("least"))
    first = lambda need: F.slice("d", F.lit(1), (F.col("m") - F.greatest(F.lit(1), F.ceil(need)) + 1).cast("int"))
    likely = shared.join(least, "fam").filter(2 * both * F.col("m") >= F.col("g") + F.col("least"))
    narrow = F.when(F.col("m") * both >= F.col("g"), first(F.col("g") / both)).alias("narrow")
    return materialise(likely.select("doc", "fam", "g", "m", narrow, first((F.col("g") + F.col("least")) / (2 * both)).alias("wide"), "d"), "with-partner")


def link_sets(sets: DataFrame, rows: DataFrame, rule: SketchRule = SketchRule()) -> DataFrame | None:
    """Components (node, comp) of the links among ``sets`` (doc, n, s1, s2, t, sketch) of ``rows`` (doc_id, text).

    Sets without a link are not in it; None if no two sets meet.
    """
    postings = materialise(_one_of_each_bucket(_meeting(_bands(sets, rule))), "buckets")
    members = materialise(sets.join(postings.groupBy("doc").agg(F.sum("c").alias("central")), "doc"), "meeting-sets")
    if members.isEmpty():
        return None
    whole = _whole_sets(members, rows, rule)
    postings = postings.select("key", "doc").join(members.select("doc", "n", "central"), "doc")
    here, turn = materialise(postings.withColumn("comp", F.col("doc")), "postings"), 0
    while True:
        # the pivot of a bucket: first the set that shares most buckets with most others, then any
        by = -F.col("central") if turn == 0 else F.xxhash64("doc", F.lit(turn))
        carried = ["doc", "comp", "n", *(["g", "m"] if turn else [])]
        pivots = here.groupBy("key").agg(F.min(F.struct(by.alias("by"), F.struct(*carried).alias("p"))).alias("x")).select("key", F.col("x.p").alias("p"))
        met = here.join(pivots, "key").filter((F.col("comp") != F.col("p.comp")) & _alike("", "p.", rule))
        met = met.filter(_may_share("", "p.", rule)) if turn else met
        found = _verified(_likely(_ordered(met, "doc", "p.doc"), members, rule), whole, rule)
        if found.isEmpty() and turn:
            break
        links = links.unionByName(found) if turn else found
        comps = _components(links).withColumnRenamed("node", "doc")
        here = materialise(_open(_named(here, comps)), "open-buckets")
        if turn == 0:
            differences = _differences(here, whole, rule)
            near = materialise(_near_core(differences), "near-core")
            if not near.isEmpty():
                links = links.unionByName(near)
                comps = _components(links).withColumnRenamed("node", "doc")
            # a set that shares too few differences with others has no partner left; without these, others share less
            partners = _with_partner(differences, comps, rule)
            partners = _with_partner(partners.select("doc", "fam", "g", "d"), comps, rule)
            here = materialise(_open(_named(here.join(partners.select("doc", "g", "m"), "doc"), comps)), "open-buckets")
            left = here.select("doc").distinct()
            members, whole = (materialise(x.join(left, "doc", "left_semi"), "left-sets") for x in (members, whole))
        turn += 1
        release_shuffles(sets.sparkSession)
        if here.select(F.coalesce(F.sum("open"), F.lit(0)) <= F.count("*")).first()[0]:
            break
    # what no pivot linked, once no round finds a link or there is little left: pairs of one bucket, different components
    # and a common difference among their rarest, at the least of these
    left = here.groupBy("doc", "n", "comp").agg(F.collect_set("key").alias("keys")).join(partners.drop("d"), "doc")
    left = materialise(left, "left-over")
    one = left.filter("narrow IS NOT NULL").select("fam", F.explode("narrow").alias("h"), "doc", "n", "comp", "g", "m", "keys", "narrow")
    other = left.select("fam", F.explode("wide").alias("h"), *(F.col(c).alias(f"other_{c}") for c in ("doc", "n", "comp", "g", "m", "keys", "wide")))
    once = F.array_min(F.array_intersect("narrow", "other_wide")) == F.col("h")
    smaller = F.struct("g", "doc") < F.struct(F.col("other_g").alias("g"), F.col("other_doc").alias("doc"))
    fits = smaller & (F.col("comp") != F.col("other_comp")) & _alike("", "other_", rule) & _may_share("", "other_", rule)
    pairs = one.join(other, ["fam", "h"]).filter(fits & F.arrays_overlap("keys", "other_keys") & once)
    last = _verified(_likely(_ordered(pairs, "doc", "other_doc"), members, rule), whole, rule)
    return _components(links.unionByName(last))


def _named(here: DataFrame, comps: DataFrame) -> DataFrame:
    """``here`` with the component of each doc from ``comps`` (doc, comp), its own if there is none."""
    return here.drop("comp").join(comps, "doc", "left").withColumn("comp", F.coalesce("comp", "doc"))


def _ordered(pairs: DataFrame, one: str, two: str) -> DataFrame:
    return pairs.select(F.least(one, two).alias("a"), F.greatest(one, two).alias("b")).distinct()


def _open(here: DataFrame) -> DataFrame:
    """Rows of buckets of several components; ``open`` is how many sets of a bucket are not of the row's component."""
    shares = here.groupBy("key", "comp").agg(F.count("*").alias("c"))
    buckets = shares.groupBy("key").agg(F.sum("c").alias("t"), F.count("*").alias("k")).filter("k > 1").select("key", "t")
    held = shares.join(buckets, "key").select("key", "comp", (F.col("t") - F.col("c")).alias("open"))
    return here.drop("open").join(held, ["key", "comp"])


def near_copies(docs: DataFrame, rule: SketchRule = SketchRule(), id_col="doc_id", text_col="text") -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id, the least doc_id reachable by links, and whether it is kept.

    A document with too few words is one shingle; null, empty and blank texts have none and link with nothing. A
    null id is in no component and kept. An id stands for one document: of rows that repeat it with other texts one
    set is linked, and all get its component. An empty table has no rows; other columns are not read. Shingles are compared by
    64 bits of their hash; two sets at the limit are missed with the probability that ``SketchRule`` states.
    """
    tune(docs.sparkSession)
    rows = id_and_text(docs, id_col, text_col)
    described = materialise(_describe(rows, rule), "sketches")
    documents = described.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max(F.struct("n", "s1", "s2")).alias("s")).select("doc_id", "s.*")
    documents = materialise(documents, "set-of-id")
    classes = materialise(documents.filter("n > 0").groupBy("n", "s1", "s2").agg(F.min("doc_id").alias("doc")), "set-classes")
    chosen = described.withColumnRenamed("doc_id", "doc").join(classes, ["doc", "n", "s1", "s2"])
    sets = materialise(chosen.groupBy("doc", "n", "s1", "s2").agg(F.max("t").alias("t"), F.first("sketch").alias("sketch")), "sets")
    labels = link_sets(sets, rows.filter("doc_id IS NOT NULL"), rule)
    named = documents.join(classes, ["n", "s1", "s2"], "left")
    if labels is not None:
        named = named.join(labels.withColumnRenamed("node", "doc"), "doc", "left")
        named = named.withColumn("doc", F.coalesce("comp", "doc"))
    named = named.select("doc_id", F.coalesce("doc", "doc_id").alias("component_id"))
    out = described.select("doc_id", F.col("n").alias("n_shingles")).join(named, "doc_id", "left")
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def keep_one_of_each(docs: DataFrame, rule: SketchRule = SketchRule(), id_col="doc_id", text_col="text") -> DataFrame:
    """The rows of ``docs`` that ``near_copies`` keeps, all columns; a repeated id keeps its rows, a null id is kept."""
    other = fresh(docs, "other_id")
    others = materialise(near_copies(docs, rule, id_col, text_col).filter("NOT kept").select(F.col("doc_id").alias(other)).distinct(), "near-copies")
    return docs.join(others, F.col(id_col) == F.col(other), "left_anti")
