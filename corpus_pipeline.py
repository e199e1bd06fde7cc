"""Corpus pipeline: quality rules, quality classifier, n-gram Jaccard join,
substring dedup, packing.  Each stage takes the rows its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlab.llm import jaccard_join, packing, quality_rank, quality_rules, span_dedup
from flowlab.llm.common import saved, ship_package
from flowlab.llm.queries import fitted_quality
from flowlab.sources import load_table

#: Near copies share 80 % of their five-word shingles; op6_jaccard_join has a contract of its own.
NEAR_WORDS, NEAR_PERCENT = 5, 80


def _retexted(kept: DataFrame, text: str, columns: list[str]) -> DataFrame:
    """``columns`` of ``kept`` with the text and its length replaced."""
    new = {"text": F.col(text), "n_chars": F.length(text).cast("bigint")}
    return kept.select(*[new[c].alias(c) if c in new else F.col(f"in_{c}").alias(c) for c in columns])


def _renamed(docs: DataFrame) -> DataFrame:
    """All columns as ``in_<name>`` beside the text, so that none clashes."""
    return docs.select(*[F.col(c).alias(f"in_{c}") for c in docs.columns], "text")


def rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Failing lines go, rejected documents go."""
    own = _renamed(docs)
    judged = quality_rules.quality_rules(own, carry=tuple(c for c in own.columns if c.startswith("in_") and c != "in_text"))
    return _retexted(judged.filter("kept"), "clean_text", docs.columns)


def classifier_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted to be of low quality go.  The model is fitted on the
    labelled source documents."""
    own = _renamed(docs)
    scored = quality_rank.score_quality(own, fitted_quality(spark, sf_dir),
                                        carry=tuple(c for c in own.columns if c.startswith("in_")))
    return scored.filter("predicted = 1").select(*[F.col(f"in_{c}").alias(c) for c in docs.columns])


def jaccard_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component its leading row stays (the smallest id); rows that
    repeat id and text are one document.  Texts without words all stay."""
    parts = jaccard_join.jaccard_components(docs.select("doc_id", "text"), words=NEAR_WORDS, percent=NEAR_PERCENT)
    first = parts.filter("leader").select(F.xxhash64("doc_id", "text_key").alias("__key"))
    kept = docs.withColumn("__key", F.xxhash64("doc_id", F.xxhash64("text"))).join(first, "__key", "left_semi")
    return kept.dropDuplicates(["__key", "doc_id"]).select(*docs.columns)


def spans_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated passages go; every document stays."""
    own = docs.select("doc_id", "text", *[F.col(c).alias(f"in_{c}") for c in docs.columns])
    return _retexted(span_dedup.remove_repeats(own), "text", docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences, with their ids."""
    return packing.pack(docs.select("doc_id", "text"))


STAGES = [
    ("quality rules", rules_stage),
    ("quality classifier", classifier_stage),
    ("n-gram Jaccard join", jaccard_stage),
    ("substring dedup", spans_stage),
    ("packing", packing_stage),
]
ORACLE_SQL = None  # learned scores and tokenizers have no SQL form


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    out = load_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        out = saved(stage(spark, out, sf_dir), "stage-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, out, sf_dir)
