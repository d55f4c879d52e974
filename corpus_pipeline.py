"""A corpus pipeline of the training-data operators.

Each stage takes (spark, docs, sf_dir), works on all rows it gets and returns a DataFrame, which ``run`` writes as
Parquet below the shared checkpoint folder and reads again as the next stage's docs. All stages but the last
return the columns of ``documents``. Nulls, empty texts and empty tables follow the operators' defined results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesync.llm.common import crc_mod, stash, table
from tablesync.llm.lang_id import UNDETERMINED, fit_language_model, predict_language
from tablesync.llm.mixing import mix_sources, repeated
from tablesync.llm.near_dups import without_near_duplicates
from tablesync.llm.packing import pack_documents
from tablesync.llm.pii import replace_entities
from tablesync.llm.queries import tokenizer_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Predict every document's language, which replaces ``lang``; documents without one (no letter) go."""
    model = fit_language_model(docs.where(crc_mod("doc_id", 3) != 1))
    found = predict_language(docs.select(COLUMNS), model).where(F.col("lang_pred") != UNDETERMINED)
    return found.withColumn("lang", F.col("lang_pred")).select(COLUMNS)


def near_dups(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each class of near-duplicates."""
    return without_near_duplicates(docs.select(COLUMNS))


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data by surrogates; ``n_chars`` counts the new text."""
    out = replace_entities(docs.select(COLUMNS), key="tablesync-surrogates")
    return out.withColumn("n_chars", F.length("text").cast("long")).select(COLUMNS)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat documents as the mix of sources takes them."""
    return repeated(mix_sources(docs.select(COLUMNS))).select(COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack the documents' pieces into sequences of 1024 tokens."""
    return pack_documents(docs, tokenizer_path())


STAGES = [("language_id", language_id), ("near_dups", near_dups), ("pii", pii), ("mixing", mixing), ("packing", packing)]

#: Language models, sketches and token ids have no SQL; tests compare run() with a plain computation.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stash(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
