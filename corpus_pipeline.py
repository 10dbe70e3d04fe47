"""From raw documents to token ids: quality rules, one of each group of near copies, pseudonyms, a mix of the
sources by weight, and SentencePiece ids.

Every stage takes ``(spark, docs, sf_dir)`` and works on all that the stage before kept; ``run`` writes its result as
Parquet in the shared folder and reads it back for the next one. All stages but the last return the columns of
``documents``: the first and second drop rows, the third changes texts, the fourth drops and repeats rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallymart.llm import jaccard_join, mixing, pieces, pseudonyms, repetition
from tallymart.llm.queries import PIECE_MODEL, TEST_KEY
from tallymart.llm.shared import release_shuffles, table
from tallymart.session import materialise


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the limits on repetition."""
    return repetition.keep_good(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group that links of near copies hold together."""
    return jaccard_join.keep_one_of_each(docs)


def private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, private data in their texts under pseudonyms; ``n_chars`` follows the text."""
    changed = pseudonyms.pseudonymise(docs, TEST_KEY)
    return pseudonyms.recount(changed)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: not at all, once, or up to three times."""
    return mixing.mix(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids and the text that they decode to."""
    return pieces.encode_documents(docs, PIECE_MODEL)


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_copies),
    ("PII", private_data),
    ("mixing", source_mix),
    ("SentencePiece", token_ids),
]

# the third and fifth stage are beyond SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{k + 1}")
        release_shuffles(spark)
    return docs
