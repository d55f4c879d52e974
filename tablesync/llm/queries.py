"""The registered queries opN_<name>: each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import oracles
from .common import crc_mod, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn):
    """Register a query under its function's name."""
    QUERIES[fn.__name__] = fn
    return fn


def tokenizer_path() -> str:
    """The byte-level BPE vocabulary of the installed public tokenizers."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .lang_id import fit_language_model, predict_language

    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", (crc_mod("doc_id", 3) == 1).alias("held_out"))
    model = fit_language_model(docs.where(~F.col("held_out")))
    return predict_language(docs.drop("lang"), model).select("doc_id", "held_out", "lang_pred", "score")


@query
def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import pack_documents

    return pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())


@query
def op6_subword_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .subword import score_documents

    return score_documents(table(spark, sf_dir, "documents"), crc_mod("doc_id", 7) == 2, public_tokenizers.path("piece_bpe_32k.model"))


@query
def op9_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .mixing import mix_sources

    return mix_sources(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@query
def op7_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .pii import replace_entities

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return replace_entities(docs, key="tablesync-surrogates")


@query
def op4_prob_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .near_dups import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"))


@query
def op3_line_block_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .html_text import extract_main_text

    return extract_main_text(table(spark, sf_dir, "pages"))


@query
def op5_spherical_kmeans(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .vectors import link_vectors

    return link_vectors(table(spark, sf_dir, "embeddings"))


@query
def op2_block_max_wand(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .bm25 import top_k_search

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    queries = docs.where(F.col("doc_id") % 50 == 0).withColumnRenamed("doc_id", "query_id")
    return top_k_search(docs, queries)


@query
def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents as files: the table has no paths, so source and id make them, with license files on two levels."""
    from .licenses import scan_licenses

    n = F.floor(F.col("doc_id") / 20)
    upper = F.concat_ws("/", F.col("source"), F.concat(F.lit("d"), F.floor(n / 50)))
    lower = F.concat_ws("/", upper, F.concat(F.lit("e"), F.floor(n / 10) % 5))
    path = F.when(n % 50 == 0, F.concat_ws("/", upper, F.lit("LICENSE"))).when(n % 5 == 0, F.concat_ws("/", lower, F.concat(F.lit("LICENSE."), n)))
    path = path.otherwise(F.concat_ws("/", lower, F.concat(F.lit("file"), n)))
    return scan_licenses(table(spark, sf_dir, "documents").select("doc_id", path.alias("path"), "text"))


@query
def op11_interval_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest of the documents, and what becomes of the root where every seventh row (by crc32) is tampered with."""
    from .manifest import fold, merkle_manifest, proof_digest, row_digest

    names = ["doc_id", "source", "lang", "n_chars", "text"]
    forged = row_digest([F.col(c) + 1 if c == "n_chars" else F.col(c) for c in names])
    docs = table(spark, sf_dir, "documents")
    found = merkle_manifest(docs, names, "lang", "doc_id", [F.col("doc_id"), F.when(crc_mod("doc_id", 7) == 0, forged).alias("forged")])
    found = found.withColumn("folded_root", fold(F.coalesce("forged", "leaf"), F.col("path")))
    return found.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


@query
def op12_document_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .fp_search import trie_search

    return trie_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op13_previous_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .repeats import remove_repeats

    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["start"])
    return remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )


ORACLE.update(oracles.all_sql())
