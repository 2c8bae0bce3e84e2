"""From raw documents to packed sequences: language ID, near-duplicates, decontamination, pseudonyms, packing.

Each stage takes (spark, docs, sf_dir), works on every row its predecessor kept and returns the columns of
documents, the last one pieces of sequences with their token ids. `run` writes each stage's rows as Parquet in
the shared folder and reads them again for the next.

Null, empty and blank texts and those without letters go with the first stage, as no language is identified. Repeated
rows and ties: the row of the smallest doc_id stays, the first of equal ones; of a group without doc_ids one row.
Nulls in other columns, and extra columns of any name, are carried to the last stage, which returns its own columns.
Texts are worked on whole at any length. Empty tables give no pieces; a benchmark without items drops nothing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from basketry.functions.lineage import fresh_path
from basketry.llm import decontaminate, langid, packing, pii, simhash
from basketry.llm.common import read_table
from basketry.llm.tokens import tokenizer_path


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose language is identified."""
    return langid.keep_identified(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates, that of the smallest doc_id."""
    return simhash.drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows in which no benchmark item leaks."""
    return decontaminate.drop_leaked(docs, read_table(spark, sf_dir, "benchmark"))


def pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, personal data in their text replaced."""
    return pii.pseudonymise(docs, pii.session_key(spark))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences, in the sources' own proportions."""
    return packing.pack_documents(docs, tokenizer_path(packing.TOKENIZER))


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("pseudonyms", pseudonyms),
    ("packing", pack),
]
# The stages' methods are no SQL; tests/llm compares them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces that the documents of a folder are packed into."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = fresh_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


QUERIES = {"pipeline": run}
SQL: dict[str, str] = {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
