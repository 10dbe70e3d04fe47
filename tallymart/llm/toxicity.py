"""Toxic passages by maximum-scoring segments.

Words get the log-odds of the two classes with an informative Dirichlet prior. Less a drift, they are a score
whose expected sum falls on clean text, so that a passage stands out as a segment with a positive sum; one
linear scan finds all maximal segments of a text. How high a clean text's best segment gets by chance
follows an extreme-value distribution, fitted to the clean training texts by length; a segment counts if
it is significant under it, and the document's score is calibrated on its significance.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymart.llm.shared import id_and_text, slices
from tallymart.session import materialise, tune

TERM = re.compile(r"[^\W\d_]+")
EULER = 0.5772156649015329


@dataclass(frozen=True)
class ToxicityRule:
    """``train_rows`` bounds the labelled rows that are fitted on, ``max_terms`` the words of the model, the
    most significant ones; so both may be broadcast. ``prior`` is the weight of the Dirichlet prior in
    documents, ``drift`` what a word costs, ``significance`` the chance at which a passage counts."""

    train_rows: int = 200_000
    max_terms: int = 20_000
    min_documents: int = 3
    certainty: float = 3.0
    prior: float = 50.0
    drift: float = 0.5
    significance: float = 0.01
    histogram_bins: int = 400


@dataclass(frozen=True)
class ToxicityModel:
    """Word scores; the extreme-value location ``low + slope * ln n`` and scale; the calibration."""

    scores: dict[str, float]
    drift: float
    low: float = 0.0
    slope: float = 0.0
    scale: float = 1.0
    offset: float = 0.0
    gain: float = 1.0
    significance: float = 0.01

    def threshold(self, n_terms: int) -> float:
        """The segment score that a clean text of this length exceeds with chance ``significance``."""
        return self.low + self.slope * math.log(n_terms + 1) - self.scale * math.log(-math.log1p(-self.significance))


def in_training(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 != 0


def training_rows(labels: DataFrame, rule: ToxicityRule) -> DataFrame:
    """At most ``train_rows`` labelled rows outside the held-out fold, chosen by a hash of the id."""
    usable = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).filter(
        F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & in_training(F.col("doc_id"))
    )
    one_each = usable.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    return one_each.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rule.train_rows)


def term_counts(train: DataFrame) -> DataFrame:
    """Per word the toxic and clean training documents that hold it; ``train`` has text and toxic."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            held = (Counter(), Counter())
            for text, toxic in zip(part.column("text").to_pylist(), part.column("toxic").to_pylist(), strict=True):
                held[toxic].update(set(TERM.findall((text or "").lower())))
            words = list(held[0] | held[1])
            yield pa.RecordBatch.from_pydict({
                "term": pa.array(words, pa.string()),
                "toxic": pa.array([held[1][w] for w in words], pa.int64()),
                "clean": pa.array([held[0][w] for w in words], pa.int64()),
            })

    partial = train.select("text", "toxic").mapInArrow(count, "term string, toxic long, clean long")
    return partial.groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def term_scores(counts: DataFrame, n_toxic: int, n_clean: int, rule: ToxicityRule) -> dict[str, float]:
    """Log-odds of the classes with a prior that spreads like the word does in all training documents."""
    prior = F.lit(rule.prior) * (F.col("toxic") + F.col("clean") + 1) / (n_toxic + n_clean + 1)
    in_toxic, in_clean = F.col("toxic") + prior, F.col("clean") + prior
    odds = F.log(in_toxic / (n_toxic + rule.prior - in_toxic + 1)) - F.log(in_clean / (n_clean + rule.prior - in_clean + 1))
    error = F.sqrt(1 / in_toxic + 1 / in_clean)
    best = (
        counts.filter(F.col("toxic") + F.col("clean") >= rule.min_documents)
        .select("term", odds.alias("odds"), error.alias("error"), F.abs(odds / error).alias("z"))
        .filter(F.col("z") > rule.certainty)
        .orderBy(F.desc("z"), "term")
        .limit(rule.max_terms)
        .select("term", (F.signum("odds") * (F.abs("odds") - F.col("error"))).alias("score"))
    )
    return {r["term"]: float(r["score"]) for r in best.collect()}  # max_terms rows at most


def maximal_segments(scores: list[float]) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, sum) of a sequence, left to right, in linear time.

    Each candidate keeps the running sums before (l) and after it (r); a new one swallows those back to the last
    candidate that starts lower, as long as it ends higher than that one.
    """
    found: list[tuple[int, int, float, float]] = []
    total = 0.0
    for i, s in enumerate(scores):
        before, total = total, total + s
        if s <= 0:
            continue
        start, low = i, before
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= low:
                j -= 1
            if j < 0 or found[j][3] >= total:
                found.append((start, i + 1, low, total))
                break
            start, low = found[j][0], found[j][2]
            del found[j:]
    return [(a, b, r - left) for a, b, left, r in found]


def _segments_of(text: str, model: ToxicityModel) -> tuple[int, float, list[tuple[int, int, float]]]:
    """Words of a text, its best segment's score, and its significant segments in characters."""
    words = TERM.findall(text.lower())
    get, drift = model.scores.get, model.drift
    values = [get(w, 0.0) - drift for w in words]
    if not values or max(values) <= 0:
        return len(words), 0.0, []
    segments = maximal_segments(values)
    best = max(s for _, _, s in segments)
    floor = model.threshold(len(words))
    picked = [(a, b, s) for a, b, s in segments if s >= floor]
    if not picked:
        return len(words), best, []
    places = [m.span() for m in TERM.finditer(text)] if len(text.lower()) == len(text) else None
    if places is None or len(places) != len(words):  # lower-casing moved characters: tell places in words
        return len(words), best, picked
    return len(words), best, [(places[a][0], places[b - 1][1], s) for a, b, s in picked]


FOUND = "doc_id long, n_terms long, best double, passages array<struct<start:long,end:long,score:double>>"
PASSAGES = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))


def scan(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """Per row of ``docs`` (doc_id, text) its words, best segment and significant passages; no shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # max_terms words at most

    def look(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            rows = [_segments_of(t or "", shared.value) for t in part.column("text").to_pylist()]
            passages = [[{"start": a, "end": b, "score": s} for a, b, s in r[2]] for r in rows]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.float64()), pa.array(passages, PASSAGES)],
                ["doc_id", "n_terms", "best", "passages"],
            )

    return docs.mapInArrow(look, FOUND)


def _surprise(best: Column, n_terms: Column, model: ToxicityModel) -> Column:
    """Minus the log chance that a clean text of this length has so good a segment, bounded to 0 .. 50."""
    z = (best - model.low - model.slope * F.log(n_terms + 1)) / model.scale
    tail = F.exp(-z)
    chance = F.when(tail < 1e-8, tail).otherwise(1 - F.exp(-tail))
    return F.least(F.lit(50.0), F.greatest(F.lit(0.0), -F.log(F.greatest(chance, F.lit(1e-30)))))


def fit_extremes(best: DataFrame, model: ToxicityModel) -> ToxicityModel:
    """Fit location and scale of the best segment of clean training texts (``best``, ``n_terms``).

    Location is linear in the log of the length: least squares over the sums that one aggregation gives.
    The best hundredth is pulled in to its lower end, since some texts labelled clean are near copies of toxic ones.
    """
    edge = best.agg(F.percentile_approx("best", 0.99, 10_000).alias("edge")).first()["edge"] or 0.0
    x, y = F.log(F.col("n_terms") + 1), F.least(F.col("best"), F.lit(edge))
    row = best.agg(F.count("*").alias("n"), *(F.coalesce(F.sum(v), F.lit(0.0)).alias(k) for k, v in {"x": x, "y": y, "xx": x * x, "xy": x * y, "yy": y * y}.items())).first()
    if row["n"] < 2:
        return model
    n = row["n"]
    var_x, cov = row["xx"] / n - (row["x"] / n) ** 2, row["xy"] / n - row["x"] * row["y"] / n**2
    slope = max(0.0, cov / var_x) if var_x > 1e-9 else 0.0
    mean = (row["y"] - slope * row["x"]) / n
    spread = max(0.0, row["yy"] / n - (row["y"] / n) ** 2 - 2 * slope * cov + slope * slope * var_x)
    scale = max(0.05, math.sqrt(6 * spread) / math.pi)
    return ToxicityModel(**model.__dict__ | {"low": mean - EULER * scale, "slope": slope, "scale": scale})


def calibrate(surprises: DataFrame, model: ToxicityModel, bins: int) -> ToxicityModel:
    """Logistic regression of the label (``toxic``) on the surprise, from a histogram of at most ``2 * bins`` rows."""
    width = 50.0 / bins
    place = F.least(F.lit(bins - 1), F.floor(F.col("surprise") / width)).cast("int")
    rows = surprises.groupBy(place.alias("bin"), "toxic").agg(F.count("*").alias("n")).collect()
    x = np.array([(r["bin"] + 0.5) * width for r in rows])
    y, n = np.array([float(r["toxic"]) for r in rows]), np.array([float(r["n"]) for r in rows])
    if not len(rows) or y.min() == y.max():
        share = (float((y * n).sum()) + 1) / (float(n.sum()) + 2) if len(rows) else 0.5
        return ToxicityModel(**model.__dict__ | {"offset": math.log(share / (1 - share)), "gain": 0.0})
    beta, pull = np.zeros(2), np.diag([1e-6, 1e-3])
    design = np.stack([np.ones_like(x), x], 1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        slope = design.T @ (n * (y - p)) - pull @ beta
        step = np.linalg.solve((design * (n * p * (1 - p) + 1e-9)[:, None]).T @ design + pull, slope)
        beta += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return ToxicityModel(**model.__dict__ | {"offset": float(beta[0]), "gain": float(max(0.0, beta[1]))})


def score_toxicity(docs: DataFrame, labels: DataFrame, rule: ToxicityRule = ToxicityRule(), id_col="doc_id", text_col="text") -> tuple[DataFrame, ToxicityModel]:
    """Fit on the training fold of ``labels`` and score every row of ``docs``; returns the scores and the model.

    Per row: doc_id, held_out (null id: false), score, predicted, passages. A null or empty text has no words and
    gets the score of a text without any segment. Without labels every score is 0.5 or below by prior alone.
    """
    spark = tune(docs.sparkSession)
    rows = id_and_text(docs, id_col, text_col)
    train = F.broadcast(materialise(training_rows(labels, rule), "toxic-train"))  # train_rows at most
    sizes = {r["toxic"]: r["n"] for r in rows.select("doc_id").join(train, "doc_id").groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    counts = term_counts(rows.join(train, "doc_id"))
    scores = term_scores(counts, sizes.get(1, 0), sizes.get(0, 0), rule)
    model = ToxicityModel(scores, rule.drift, significance=rule.significance)
    # the extreme-value fit needs the clean training texts' best segments, the passages need the fit
    clean = materialise(scan(rows.join(train.filter("toxic = 0").select("doc_id"), "doc_id"), model).select("n_terms", "best"), "toxic-clean")
    model = fit_extremes(clean, model)
    found = materialise(scan(rows, model), "toxic-scan")
    surprise = _surprise(F.col("best"), F.col("n_terms"), model)
    seen = found.join(train, "doc_id").select(surprise.alias("surprise"), "toxic")
    model = calibrate(seen, model, rule.histogram_bins)
    score = 1 / (1 + F.exp(-(F.lit(model.offset) + F.lit(model.gain) * surprise)))
    scored = found.select("doc_id", F.coalesce(~in_training(F.col("doc_id")), F.lit(False)).alias("held_out"), score.alias("score"), "passages")
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "passages"), model
