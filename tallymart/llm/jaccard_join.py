"""N-gram Jaccard join by grouped prefixes, and the components of its links.

Every document is a set of word shingles. Sets that are equal are one. A census tells which shingles occur in
more sets, and in how many; a set whose shared shingles cannot reach the similarity has no partner. The others
order their shingles from rare to frequent; two similar sets must then share one of their first few, their
prefixes. Sets with the same prefix and size form one group: groups are joined on the shingles of their
prefixes, pairs of groups are filtered by size and by the places of the shared shingle, and only what is left
is expanded to members and verified on the whole sets.

Links are needed up to their components, so a large family of near copies is never expanded into all pairs.
First, every prefix shingle links its groups to one of them. Sets that verify are one component. Then only
pairs of different components are left, and of those, all are verified.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymart.llm.census import joined, shared_features
from tallymart.llm.shared import fresh, id_and_text, mix64, release_shuffles, slices, window_hashes, word_hashes
from tallymart.session import materialise, tune


HASH_RUN = 1 << 19  # bytes whose hashes are in memory at a time


@dataclass(frozen=True)
class JoinRule:
    """Sets of ``width`` words link at ``100 * intersection >= percent * union``."""

    width: int = 5
    percent: int = 75
    star_rounds: int = 2

    def least(self, n: Column) -> Column:
        """Shingles that a set of size n must share with any partner."""
        return F.ceil(n * self.percent / 100)

    def overlap(self, sizes: Column) -> Column:
        """Shingles that two sets of so many together must share."""
        return F.ceil(sizes * self.percent / (100 + self.percent))


def _sets(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of each text, as hashes, and the text of each; sorted by text, then hash."""
    hashes, owner = window_hashes(*word_hashes(texts, lower=True), width)
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    once = np.r_[True, (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])][: len(hashes)]
    return hashes[once], owner[once]


def _signatures(hashes: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Size of each set and 128 bits that equal sets share: two sums of its mixed hashes."""
    sizes = np.bincount(owner, minlength=n)
    first = np.r_[0, np.cumsum(sizes)]
    signs = []
    for salt in (0x243F6A8885A308D3, 0x13198A2E03707344):
        sums = np.r_[np.uint64(0), np.cumsum(mix64(hashes ^ np.uint64(salt)), dtype=np.uint64)]
        signs.append((sums[first[1:]] - sums[first[:-1]]).view(np.int64))
    return sizes, *signs


def _describe(rows: DataFrame, width: int) -> DataFrame:
    """Per row of ``rows`` (doc_id, text): doc_id, n, s1, s2."""

    def describe(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", HASH_RUN):
            n, s1, s2 = _signatures(*_sets(part.column("text"), width), part.num_rows)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(n, pa.int64()), pa.array(s1), pa.array(s2)], ["doc_id", "n", "s1", "s2"])

    return rows.mapInArrow(describe, "doc_id long, n long, s1 long, s2 long")


def _members(rows: DataFrame, chosen: DataFrame, total: int, rule: JoinRule) -> DataFrame:
    """Per chosen set that can have a partner: doc, n, tokens (sorted, packed) and its prefix of shared tokens."""

    def emit(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        found, row = [], 0
        for sub in slices([part], "text", HASH_RUN):
            hashes, owner = _sets(sub.column("text"), rule.width)
            _, s1, s2 = _signatures(hashes, owner, sub.num_rows)
            # of rows that share an id, the chosen one
            right = (s1 == sub.column("s1").to_numpy()) & (s2 == sub.column("s2").to_numpy())
            keep = right[owner]
            found.append((hashes[keep], owner[keep] + row))
            row += sub.num_rows
        return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])

    shared = shared_features(rows.join(chosen, "doc_id"), emit, total)

    def assemble(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, bounds = joined(batch.column("tokens"))
            doc, n, prefix, tokens = [], [], [], []
            for k, size in enumerate(batch.column("n").to_pylist()):
                own = np.sort(values[bounds[k] : bounds[k + 1]])
                long = len(own) - -(-size * rule.percent // 100) + 1  # of the shared ones; unique ones come first
                if long > 0:
                    doc.append(batch.column("doc_id")[k].as_py())
                    n.append(size)
                    prefix.append(own[:long].astype(np.int64))
                    tokens.append(own.tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc, pa.int64()), pa.array(n, pa.int64()), pa.array(tokens, pa.binary()), pa.array(prefix, pa.list_(pa.int64()))],
                ["doc", "n", "tokens", "prefix"],
            )

    sized = shared.join(chosen.select("doc_id", "n"), "doc_id").select("doc_id", "n", "tokens")
    return sized.mapInArrow(assemble, "doc long, n long, tokens binary, prefix array<long>")


def _may_link(rule: JoinRule, a: str, b: str) -> Column:
    """Size filter, and what two sets can share at most if the token at their places is the first in common."""
    na, nb, ma, mb, pa_, pb = (F.col(f"{x}.{c}") for c in ("n", "m", "pos") for x in (a, b))
    most = F.least(pa_, pb) + 1 + F.least(ma - pa_ - 1, mb - pb - 1)
    return (F.least(na, nb) * 100 >= F.greatest(na, nb) * rule.percent) & (most >= rule.overlap(na + nb))


def _verified(pairs: DataFrame, members: DataFrame, rule: JoinRule) -> DataFrame:
    """The pairs (a, b) whose whole sets link, stored."""
    side = lambda x: members.select(F.col("doc").alias(x), F.col("n").alias(f"n{x}"), F.col("tokens").alias(f"t{x}"))

    def verify(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for na, nb, ta, tb in zip(*(batch.column(c).to_pylist() for c in ("na", "nb", "ta", "tb")), strict=True):
                both = len(np.intersect1d(np.frombuffer(ta, "<u8"), np.frombuffer(tb, "<u8"), assume_unique=True))
                keep.append(100 * both >= rule.percent * (na + nb - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return materialise(pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "na", "nb", "ta", "tb").mapInArrow(verify, "a long, b long"), "links")


def components(links: DataFrame) -> DataFrame:
    """Per node of ``links`` (a, b): node and comp, the smallest node of its component; stored.

    Each round every component hooks to its smallest neighbour, chains are cut short until all point to their
    end, and links are carried over; at least half of the components that have neighbours end each time.
    """
    spark = links.sparkSession
    open_ = materialise(links.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "cc-links")
    labels = materialise(open_.select(F.explode(F.array("a", "b")).alias("node")).distinct().select("node", F.col("node").alias("comp")), "cc-labels")
    while not open_.isEmpty():
        both = open_.unionByName(open_.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hook = materialise(both.groupBy(F.col("a").alias("x")).agg(F.min("b").alias("m")).select("x", F.least("x", "m").alias("to")), "cc-hook")
        while True:
            onward = hook.select(F.col("x").alias("to"), F.col("to").alias("further"))
            jumped = materialise(hook.join(onward, "to").select("x", "to", "further"), "cc-jump")
            hook = jumped.select("x", F.col("further").alias("to"))
            if jumped.filter("to <> further").isEmpty():
                break
        to = hook.select("x", "to")
        labels = materialise(labels.join(to, labels["comp"] == to["x"], "left").select("node", F.coalesce("to", "comp").alias("comp")), "cc-labels")
        ends = open_.join(to.select(F.col("x").alias("a"), F.col("to").alias("ca")), "a").join(to.select(F.col("x").alias("b"), F.col("to").alias("cb")), "b")
        open_ = materialise(ends.filter("ca <> cb").select(F.least("ca", "cb").alias("a"), F.greatest("ca", "cb").alias("b")).distinct(), "cc-links")
        release_shuffles(spark)
    return labels


def link_members(members: DataFrame, rule: JoinRule) -> DataFrame:
    """Components (node, comp) of the links among ``members``; members without a link are not in it."""
    grouping = members.groupBy("n", "prefix").agg(F.min("doc").alias("lead"), F.max(F.length("tokens") / 8).cast("long").alias("m"))
    groups = materialise(grouping.withColumn("grp", F.col("lead")), "groups")
    in_group = materialise(
        # alike: has enough shared tokens to link to a set of its own size, as all of its group are
        members.select("doc", "n", "prefix", (F.length("tokens") / 8 >= rule.overlap(2 * F.col("n"))).alias("alike"))
        .join(groups.select("n", "prefix", "grp"), ["n", "prefix"])
        .select("doc", "grp", "alike"),
        "in-group",
    )
    # one row per group and token of its prefix; m is the largest number of shared tokens of a member
    postings = materialise(_one_token_per_list(groups.select("grp", "n", "m", F.posexplode("prefix").alias("pos", "token"))), "postings")
    own_lead = in_group.filter("doc <> grp AND alike").select(F.col("grp").alias("a"), F.col("doc").alias("b"))
    at = lambda *more: F.struct("grp", "n", "m", "pos", *more)

    links, labels = None, None
    for r in range(rule.star_rounds):
        # each token's pivot: the group with the fewest shingles of its own, which edits of one text have in
        # common with most others; in later rounds any group
        own = (F.col("n") - F.col("m")) if r == 0 else F.lit(0)
        by = F.struct(own.alias("own"), F.xxhash64("grp", F.lit(r)).alias("by"), at().alias("p"))
        pivots = postings.groupBy("token").agg(F.min(by).alias("x"), F.count("*").alias("c"))
        pivots = pivots.filter("c > 1").select("token", F.col("x.p").alias("p"))
        near = postings.select("token", at().alias("q")).join(pivots, "token").filter((F.col("p.grp") != F.col("q.grp")) & _may_link(rule, "p", "q"))
        pairs = near.select(F.col("p.grp").alias("a"), F.col("q.grp").alias("grp")).distinct()
        pairs = pairs.join(in_group, "grp").select("a", F.col("doc").alias("b"))
        pairs = (pairs.unionByName(own_lead) if r == 0 else pairs).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        if labels is not None:
            pairs = _apart(pairs, labels)
        found = _verified(pairs, members, rule)
        links = found if links is None else links.unionByName(found)
        labels = components(links)

    # all pairs of different components that share a token of their prefixes
    comp = F.coalesce("comp", "doc")
    nodes = in_group.join(labels.withColumnRenamed("node", "doc"), "doc", "left").select("doc", "grp", "alike", comp.alias("comp"))
    spread = postings.join(nodes, "grp").select("token", at("doc", "comp").alias("x"))
    sizes = spread.groupBy("token", F.col("x.comp").alias("comp")).agg(F.count("*").alias("c"))
    largest = sizes.groupBy("token").agg(F.max(F.struct("c", "comp")).alias("top"), F.count("*").alias("comps"))
    mixed = materialise(largest.filter("comps > 1").select("token", F.col("top.comp").alias("top")), "mixed")
    placed = spread.join(mixed, "token")
    own = postings.join(mixed, "token").groupBy("grp").agg(F.collect_list("token").alias("tokens"))
    placed = materialise(placed.withColumn("grp", F.col("x.grp")).join(own, "grp").drop("grp"), "placed")
    # members of a token's largest component meet only those of others
    few = placed.filter("x.comp <> top").select("token", F.col("x").alias("p"), F.col("tokens").alias("ptokens"))
    every = placed.select("token", F.col("x").alias("q"), "top", F.col("tokens").alias("qtokens"))
    once = F.array_min(F.array_intersect("ptokens", "qtokens")) == F.col("token")  # a pair meets at one of its tokens
    meet = few.join(every, "token").filter(
        (F.col("p.comp") != F.col("q.comp")) & ((F.col("q.comp") == F.col("top")) | (F.col("p.doc") < F.col("q.doc"))) & _may_link(rule, "p", "q") & once
    )
    pairs = meet.select(F.least("p.doc", "q.doc").alias("a"), F.greatest("p.doc", "q.doc").alias("b")).distinct()
    # within a group, those that do not link to its lead
    alike = nodes.filter("alike")
    inner = alike.select("grp", F.col("doc").alias("a"), F.col("comp").alias("ca")).join(alike.groupBy("grp").agg(F.countDistinct("comp").alias("k")).filter("k > 1"), "grp")
    same = inner.join(alike.select("grp", F.col("doc").alias("b"), F.col("comp").alias("cb")), "grp").filter("a < b AND ca <> cb").select("a", "b")
    last = _verified(pairs.unionByName(same).distinct(), members, rule)
    return components(links.unionByName(last))


def _one_token_per_list(postings: DataFrame) -> DataFrame:
    """``postings`` without tokens of one group, and with one of all tokens that the same groups have.

    The tokens of a passage lead to the same pairs; any one of them does, since both filters hold for every token in common.
    """
    lists = postings.groupBy("token").agg(F.count("*").alias("c"), *(F.sum(F.xxhash64("grp", F.lit(k)).cast("decimal(38,0)")).alias(f"s{k}") for k in (1, 2)))
    kept = lists.filter("c > 1").groupBy("c", "s1", "s2").agg(F.min("token").alias("token")).select("token")
    return postings.join(kept, "token", "left_semi")


def _apart(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The pairs (a, b) that are not in one component yet."""
    of = lambda x: labels.select(F.col("node").alias(x), F.col("comp").alias(f"c{x}"))
    known = pairs.join(of("a"), "a", "left").join(of("b"), "b", "left")
    return known.filter(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("a", "b")


def link_documents(docs: DataFrame, rule: JoinRule = JoinRule(), id_col="doc_id", text_col="text") -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id, the smallest doc_id reachable by links.

    A null or empty text, or one without words, has an empty set and is linked with nothing. A null id is in no
    component (null). An id stands for one document: of rows that repeat it with other texts, one set is
    linked, and all get its component. Shingles are compared by 48 bits of their hash.
    """
    spark = tune(docs.sparkSession)
    rows = id_and_text(docs, id_col, text_col)
    sets = materialise(_describe(rows, rule.width), "sets")
    documents = sets.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max(F.struct("n", "s1", "s2")).alias("s")).select("doc_id", "s.*")
    documents = materialise(documents, "set-of-id")
    filled = documents.filter("n > 0")
    # equal sets are one, that of the smallest id
    classes = materialise(filled.groupBy("n", "s1", "s2").agg(F.min("doc_id").alias("first")), "set-classes")
    total = classes.agg(F.sum("n")).first()[0] or 0
    chosen = classes.select(F.col("first").alias("doc_id"), "n", "s1", "s2")
    members = materialise(_members(rows.filter("doc_id IS NOT NULL"), chosen, total, rule), "members")
    release_shuffles(spark)
    labels = link_members(members, rule)
    release_shuffles(spark)
    comp = F.coalesce("comp", "first", "doc_id").alias("component_id")
    firsts = documents.join(classes, ["n", "s1", "s2"], "left").join(labels, F.col("first") == F.col("node"), "left").select("doc_id", comp)
    return sets.select("doc_id", F.col("n").alias("n_shingles")).join(firsts, "doc_id", "left")


def keep_one_of_each(docs: DataFrame, rule: JoinRule = JoinRule(), id_col="doc_id", text_col="text") -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of its component, all columns; a repeated id keeps its rows,
    a null id is kept."""
    linked = link_documents(docs, rule, id_col, text_col)
    other = fresh(docs, "other_id")
    others = materialise(linked.filter("doc_id <> component_id").select(F.col("doc_id").alias(other)).distinct(), "near-copies")
    return docs.join(others, F.col(id_col) == F.col(other), "left_anti")
