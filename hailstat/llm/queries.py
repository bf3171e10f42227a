"""One query per corpus operator, over the tables of a folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hailstat.llm import (
    alignment,
    bytepairs,
    contamination,
    licenses,
    lines,
    minhash,
    packing,
    pages,
    personal,
    substrings,
    toxicity,
    variants,
    vectors,
)
from hailstat.llm.tables import table


def op1_suffix_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page, and how many of its words repeat on other pages of the host."""
    return pages.main_text(table(spark, sf_dir, "pages"))


def op2_suffix_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents in which ten words of a benchmark item stand."""
    return contamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_superkmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that no earlier window of twenty words covers."""
    return substrings.substring_dedup(table(spark, sf_dir, "documents")).drop("kept")


def op4_pivots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors with a cosine of 0.9 or more, through the pivot-permutation index."""
    return vectors.near_vectors(table(spark, sf_dir, "embeddings"))


def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases, and lines that hold most words of a license sentence."""
    return licenses.license_scan(table(spark, sf_dir, "documents"))


def op6_personal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data: the exact kinds, and what the labelers' votes add."""
    return personal.personal_data(table(spark, sf_dir, "documents"))


def op7_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts without the lines that spread over ten sites or more."""
    return lines.line_dedup(table(spark, sf_dir, "documents"))


def op8_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of 1024 tokens, every window with the sources' proportions."""
    return packing.pack(table(spark, sf_dir, "documents"))


def op9_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate documents: 2-word shingles, similarity of 0.8 or more."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), size=2, percent=80)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learnt from the labels outside the held-out fifth."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = toxicity.toxicity(docs, toxicity.learn(docs, labels.where(~toxicity.held_out())))
    return scored.select("doc_id", toxicity.held_out().alias("held_out"), "score", "predicted")


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links between the tokens of two tokenizers, and how often linked ids meet."""
    return alignment.alignment(table(spark, sf_dir, "documents"))


def op12_rank_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text encoded by byte-level BPE and decoded again."""
    return bytepairs.round_trip(table(spark, sf_dir, "documents"))


def op13_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of seven letters or more, their near spellings and the form and root these lead to."""
    return variants.spelling_variants(table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_suffix_pages,
        op2_suffix_arrays,
        op3_superkmers,
        op4_pivots,
        op5_licenses,
        op6_personal,
        op7_lines,
        op8_mixture,
        op9_minhash,
        op10_toxicity,
        op11_alignment,
        op12_rank_queue,
        op13_variants,
    )
}
ORACLE: dict[str, str] = {"op7_lines": lines.ORACLE_SQL}
