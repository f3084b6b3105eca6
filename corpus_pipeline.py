"""A training corpus from raw documents: known languages, one of each near copy, no secrets, mixed sources, token ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tastegraph.llm import bpe, jaccard, langid, mixing, secrets
from tastegraph.llm.common import read_table, written
from tastegraph.llm.queries import byte_vocabulary


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; those without a letter and those below the calibrated threshold go."""
    found = langid.language(docs, langid.fit(docs), F.col("text"))
    judged = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), found.alias("found"))
    return judged.where(~F.col("found.rejected")).select("row.*")


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five words, a similarity of 0.8 or more."""
    return jaccard.one_of_each(docs, n=5, per_cent=80)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The same documents with every secret replaced by a mark; n_chars follows the text."""
    clean = secrets.redacted(docs, secrets.fit(docs), F.col("text"))
    judged = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), clean.alias("clean"))
    changed = {"text": F.col("clean")}
    if "n_chars" in docs.columns:
        kept = F.col("row.n_chars")
        changed["n_chars"] = F.when(F.col("row.text").eqNullSafe(F.col("clean")), kept).otherwise(F.char_length("clean")).cast(docs.schema["n_chars"].dataType)
    return judged.select(*[changed.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    chosen = mixing.mix(docs, carry=True).where("copies > 0")
    return chosen.select("row", F.explode(F.sequence(F.lit(1), "copies"))).select("row.*")


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, ids_sha256, decoded_sha256) of each document."""
    coded = bpe.there_and_back(docs, byte_vocabulary())
    return coded.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids",
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"))


STAGES = [
    ("language ID", known_language),
    ("n-gram Jaccard join", one_of_near_copies),
    ("secret scans", without_secrets),
    ("mixing sources", mixed_sources),
    ("BPE", token_ids),
]

#: The language model, the secret field and hashed sampling keys are not for SQL; tests compare each stage with plain code.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs
