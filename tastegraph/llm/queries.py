"""One query for each operator, over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tastegraph.llm import bpe, html, jaccard, langid, linerules, maxscore, mixing, neighbours, periods, secrets, suffixes, warc, whitening
from tastegraph.llm.common import read_table

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(function: Query) -> Query:
    REGISTRY[function.__name__] = function
    return function


def byte_vocabulary() -> bpe.Vocabulary:
    import public_tokenizers

    return bpe.Vocabulary.read(public_tokenizers.path("byte_bpe_50k.json"))


@query
def op1_maxscore(spark: SparkSession, folder: str) -> DataFrame:
    """For every twentieth vector the 20 best others by integer inner product."""
    vectors = read_table(spark, folder, "embeddings").select("vec_id", maxscore.scaled(F.col("embedding"), 64.0).alias("vector"))
    return maxscore.top_k(vectors, vectors.where("vec_id % 20 = 0"), 20)


@query
def op2_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of each whole text, and the text that they decode to, as digests."""
    return bpe.digests(read_table(spark, folder, "documents"), byte_vocabulary())


@query
def op5_warc(spark: SparkSession, folder: str) -> DataFrame:
    """Pages written as records of seekable bundles and read back."""
    return warc.archived(read_table(spark, folder, "pages"), revisit_min_bytes=0)


@query
def op6_suffixes(spark: SparkSession, folder: str) -> DataFrame:
    """Texts without the bytes that 400-byte strings cover which start anywhere else."""
    return suffixes.without_repeats(read_table(spark, folder, "documents"), 400, first_stays=False)


@query
def op7_html(spark: SparkSession, folder: str) -> DataFrame:
    """Main text of every page."""
    return html.extracted(read_table(spark, folder, "pages"))


@query
def op10_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """Words that a mix of 150 % of all words takes of each document."""
    return mixing.mix(read_table(spark, folder, "documents"))


@query
def op3_langid(spark: SparkSession, folder: str) -> DataFrame:
    """Language of every whole text, learned from the rows that are not held out."""
    return langid.predicted(read_table(spark, folder, "documents"))


@query
def op4_secrets(spark: SparkSession, folder: str) -> DataFrame:
    """Secrets in every whole text: base patterns and what the field adds."""
    return secrets.scanned(read_table(spark, folder, "documents"))


@query
def op8_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    """Links of all vectors at a cosine of 0.95, and their components."""
    return neighbours.linked(read_table(spark, folder, "embeddings"), 0.95)


@query
def op9_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    """Components of documents whose 3-word shingles overlap by 90 per cent."""
    found = jaccard.classes(read_table(spark, folder, "documents"), n=3, per_cent=90)
    return found.select("doc_id", "n_shingles", "component_id")


@query
def op11_periods(spark: SparkSession, folder: str) -> DataFrame:
    """Runs of repeating words in every whole text, some of them planted, and the texts without the repeats."""
    return periods.digests(read_table(spark, folder, "documents"))


@query
def op12_whitening(spark: SparkSession, folder: str) -> DataFrame:
    """All usable vectors along the four leading components of the distinct ones, scaled to unit variance."""
    return whitening.whitened(read_table(spark, folder, "embeddings"), 256.0, 4)


@query
def op13_linerules(spark: SparkSession, folder: str) -> DataFrame:
    """Counts of every whole text, and the verdict of rules that judge lines first."""
    return linerules.digests(read_table(spark, folder, "documents"))
