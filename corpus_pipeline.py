"""From raw documents to packed training sequences, one operator of ``linkloom.llm`` a stage.

Each stage works on all rows its predecessor kept and is written before the next one reads it. The first four
return the columns of their input; the last returns the pieces of the packed sequences with their ids.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.llm import decontaminate, language, packing, pii, simhash
from linkloom.llm.common import named
from linkloom.session import settle

LEAST_SHARE = 0.5  # of a document that must be in one language


def _carried(docs: DataFrame) -> dict:
    """All columns by position, so that no name can clash with what an operator adds."""
    return {f"c{k}": named(name) for k, name in enumerate(docs.columns)}


def _only(found: DataFrame, docs: DataFrame) -> DataFrame:
    return found.select(*[F.col(f"c{k}") for k in range(len(docs.columns))]).toDF(*docs.columns)


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without text or letters, and those no single language holds half of.

    The languages are learned from the documents' own labels; without any label nothing is known and all go.
    """
    found = language.predict(docs, language.fit(docs), carry=_carried(docs))
    return _only(found.where((F.col("lang_pred") != language.UNDETERMINED) & (F.col("score") >= LEAST_SHARE)), docs)


def keep_one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest id of each group of linked fingerprints."""
    return simhash.one_of_each(docs)


def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents with a window of a benchmark item."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontaminate.search(docs, benchmark, carry=_carried(docs))
    return _only(found.where(~F.col("contaminated")), docs)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data in the texts by the name of its kind; ``n_chars`` follows."""
    return pii.redact(docs, pii.fit(docs), length_column="n_chars")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' tokens in sequences of 2048."""
    return packing.pack(docs, carry={"doc_id": F.col("doc_id")}, with_ids=True)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", keep_known_languages),
    ("near_duplicates", keep_one_of_near_duplicates),
    ("decontamination", drop_benchmark_passages),
    ("personal_data", redact_personal_data),
    ("packing", pack_sequences),
]

#: No SQL: XXH64 shingles, trained models and byte-pair tokens are beyond it. Tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written to the shared folder before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
