"""Training-corpus pipeline over ``documents``: quality rules, line dedup,
SimHash near-dedup, secret scan, packing.

Each stage works on all documents its predecessor kept and returns the columns
of ``documents``; the last returns one row per packed piece.  A stage's result
is written as Parquet in the shared folder and read back, so a lost executor
never repeats an earlier stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelstar.llm.line_dedup import line_dedup
from reelstar.llm.packing import pack, word_tokenizer
from reelstar.llm.quality_rules import quality_rules, trusted_rows_of
from reelstar.llm.secret_scan import secret_scan
from reelstar.llm.simhash_dedup import keep_one_per_group
from reelstar.session import drop_path, work_dir


def _plain(docs: DataFrame) -> tuple[DataFrame, str, str]:
    """``docs`` with the plain column names c0, c1, ..., so that no column can
    clash with one an operator makes; the names of its id and text."""
    at = docs.columns.index
    return docs.toDF(*[f"c{k}" for k in range(len(docs.columns))]), f"c{at('doc_id')}", f"c{at('text')}"


def _columns(made: DataFrame, docs: DataFrame, changed: bool = False) -> DataFrame:
    """The columns of ``docs`` again, with ``n_chars`` counted anew where the
    text has changed."""
    plain = made.select(*[f"c{k}" for k in range(len(docs.columns))])
    if changed and "n_chars" in docs.columns:
        n, text = docs.columns.index("n_chars"), docs.columns.index("text")
        plain = plain.withColumn(f"c{n}", F.char_length(f"c{text}").cast(docs.schema["n_chars"].dataType))
    return plain.toDF(*docs.columns)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    plain, key, text = _plain(docs)
    trusted = trusted_rows_of(spark.read.parquet(f"{sf_dir}/labels.parquet")).toDF(key)
    return _columns(quality_rules(plain, trusted, key, text).filter("kept"), docs)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that many documents share stay in one of them only."""
    return _columns(line_dedup(*_plain(docs)), docs, changed=True)


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return _columns(keep_one_per_group(*_plain(docs)), docs)


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; every document stays."""
    return _columns(secret_scan(*_plain(docs), redact=True), docs, changed=True)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents become packed sequences: one row per piece."""
    return pack(docs, word_tokenizer(public_tokenizers.path("word_bpe_49k.json")))


STAGES = [
    ("quality_rules", quality_stage),
    ("line_dedup", line_stage),
    ("simhash_dedup", simhash_stage),
    ("secret_scan", secret_stage),
    ("packing", packing_stage),
]

#: Hashed n-grams, SimHash components, the random field and the tokenizer are
#: not expressible in SQL; tests hold run() against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = None
    for name, stage in STAGES:
        path = work_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            drop_path(spark, before)
        before = path
    return docs
