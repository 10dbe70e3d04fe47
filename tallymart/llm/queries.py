"""The registered queries of the corpus operators, each over its whole table, with SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tallymart.llm import bitplanes, conversations, divergence, jaccard_join, mixing, pieces, pseudonyms, repetition, setsketch, simhash, suffix_dedup, toxicity, wrappers
from tallymart.llm.shared import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")
WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
# for the test tables; whoever uses the operator passes a secret key of their own
TEST_KEY = b"key of the test tables"


def query(name: str, sql: str | None = None):
    def register(build: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


@query("op1_sentencepiece")
def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode_documents(table(spark, sf_dir, "documents"), PIECE_MODEL)


@query("op2_html")
def op2_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrappers.main_text(table(spark, sf_dir, "pages"))


@query("op3_pii")
def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonyms.pseudonym_report(table(spark, sf_dir, "documents"), TEST_KEY)


@query("op4_suffix_dedup")
def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.dedup_report(table(spark, sf_dir, "documents"))


@query("op5_quality_rules")
def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.quality_report(table(spark, sf_dir, "documents"))


@query("op6_fingerprints")
def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.fingerprint_report(table(spark, sf_dir, "documents"))


@query("op7_toxicity")
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))[0]


@query("op8_jaccard_join")
def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.link_documents(table(spark, sf_dir, "documents"))


MIXING_SQL = r"""
WITH sized AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
           coalesce(('0x' || substr(md5(doc_id::VARCHAR), 1, 15))::BIGINT, 0) AS hash
    FROM documents),
sources AS (
    SELECT source, sum(size)::BIGINT AS source_size, 3 * sum(size)::BIGINT AS cap,
           (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight
    FROM sized GROUP BY source),
levels AS (
    SELECT *, (sum(source_size) OVER ()::BIGINT
               - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT)::DOUBLE
              / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::DOUBLE AS at_level
    FROM sources),
targets AS (
    SELECT source, source_size, least(cap::DOUBLE, max(at_level) OVER () * weight) AS target FROM levels),
rests AS (
    SELECT *, CASE WHEN source_size > 0 THEN least(3, floor(target / source_size))::BIGINT ELSE 0 END AS repeats FROM targets),
placed AS (
    SELECT d.*, r.source_size, r.target, r.repeats, r.target - r.repeats * r.source_size AS rest,
           sum(d.size) OVER (PARTITION BY d.source ORDER BY d.hash RANGE UNBOUNDED PRECEDING) AS upto
    FROM sized d JOIN rests r ON d.source IS NOT DISTINCT FROM r.source)
SELECT doc_id, size, source_size, target, (size * copies)::BIGINT AS taken, copies, source
FROM (SELECT *, repeats + CASE WHEN upto <= rest THEN 1 ELSE 0 END AS copies FROM placed)
"""


@query("op9_mixing", MIXING_SQL)
def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(table(spark, sf_dir, "documents"))


@query("op10_token_planes")
def op10_token_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bitplanes.planes_of(spark, table(spark, sf_dir, "documents"), WORD_TOKENIZER)


_LETTERS = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

DIVERGENCE_SQL = rf"""
WITH d AS (
    SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           regexp_extract_all(coalesce(text, ''), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS found
    FROM documents),
t AS (SELECT r, lang, source, translate(unnest(found), {_LETTERS}) AS term FROM d),
kept AS (SELECT lang, term, count(*)::HUGEINT AS n FROM t GROUP BY 1, 2 HAVING count(DISTINCT r) >= 10),
own AS (SELECT lang, source, term, count(*)::HUGEINT AS n FROM t SEMI JOIN kept USING (lang, term) GROUP BY 1, 2, 3),
groups AS (SELECT DISTINCT lang, source FROM d),
vocabulary AS (SELECT lang, count(*)::HUGEINT AS v, sum(n)::HUGEINT AS total FROM kept GROUP BY 1),
totals AS (
    SELECT g.lang, g.source, coalesce(sum(o.n), 0)::HUGEINT AS total FROM groups g LEFT JOIN own o ON g.lang = o.lang AND g.source = o.source
    GROUP BY 1, 2),
shares AS (
    SELECT s.lang, s.source, k.term, coalesce(o.n, 0) AS n, 1 + 1000000000::HUGEINT * (coalesce(o.n, 0) + 2) // (s.total + 2 * w.v) AS p,
           1 + 1000000000::HUGEINT * (k.n + 2) // (w.total + 2 * w.v) AS q
    FROM totals s JOIN vocabulary w ON s.lang = w.lang JOIN kept k ON k.lang = s.lang
    LEFT JOIN own o ON o.lang = s.lang AND o.source = s.source AND o.term = k.term),
sums AS (
    SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
    FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY 1, 2, 3),
pairs AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value
    FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, (p - q) * (p - q) // (p + q) AS value FROM shares WHERE n > 0 AND p > q),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
    FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM ranked WHERE part = 'pair' OR rank <= 10
"""


@query("op11_divergence_audit", DIVERGENCE_SQL)
def op11_divergence_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


@query("op12_conversation_repair")
def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair_report(table(spark, sf_dir, "conversations"))


SKETCH_SQL = rf"""
WITH RECURSIVE w AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {_LETTERS}), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (
    SELECT DISTINCT doc_id, array_to_string(ws[i : i + 2], ' ') AS shingle
    FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 1, 2))) AS i FROM w WHERE len(ws) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * k >= 85 * (x.n + y.n - k)),
reached AS (SELECT doc_id, doc_id AS other FROM w UNION SELECT r.doc_id, l.b FROM reached r JOIN links l ON r.other = l.a),
least AS (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY 1)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
FROM w JOIN least USING (doc_id) LEFT JOIN sizes USING (doc_id)
"""


@query("op13_setsketch", SKETCH_SQL)
def op13_setsketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return setsketch.near_copies(table(spark, sf_dir, "documents"))
