"""The corpus pipeline: five stages, each an operator of ``plyscope.llm`` whose decisions take effect.

Every stage takes (spark, docs, sf_dir), with docs the Parquet table its predecessor wrote, and
returns a DataFrame; all but the last return the columns of docs. Rows are told apart within a stage
by their file and place in it, so repeated rows, repeated or null ids and extra columns cause no mix-up.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plyscope.llm.common import RID, free, if_small, join_groups, numbered, scope, table, written

_HELD: dict[str, list[str]] = {}


def _stage(fn):
    """A stage whose own tables are freed when the next one begins: its result must be written by then."""
    @functools.wraps(fn)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        app = spark.sparkContext.applicationId
        free(spark, _HELD.pop(app, []))
        with scope() as paths:
            out = fn(spark, docs, sf_dir)
        _HELD[app] = paths
        return out
    return run


def _numbered(docs: DataFrame) -> tuple[DataFrame, list[str]]:
    return numbered(docs), [c for c in docs.columns if c != RID]


def _without(docs: DataFrame, names: list[str], dropped: DataFrame) -> DataFrame:
    """``docs`` without the rows whose row id is in ``dropped``, which is written first. Few ids are
    broadcast, so that no text is shuffled; many are joined."""
    gone = if_small(written(dropped.select(F.col("doc_id").alias("__gone"))))
    return docs.join(gone, docs[RID] == gone["__gone"], "left_anti").select(*[F.col(f"`{c}`") for c in names])


@_stage
def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    from plyscope.llm.quality import score_quality
    docs, names = _numbered(docs)
    scored = score_quality(docs, table(spark, sf_dir, "labels"), keep_columns=[RID])
    return _without(docs, names, scored.filter("rejected").select(F.col(RID).alias("doc_id")))


@_stage
def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents (five-word shingles, similarity 0.8) the one with the
    smallest id stays; documents without words are linked with nothing and stay."""
    from plyscope.llm.jaccard import jaccard_groups
    docs, names = _numbered(docs)
    groups = written(jaccard_groups(docs, id_col=RID).select(F.col("doc_id").alias(RID), "component_id"))
    named = groups.join(docs.select(RID, F.col("doc_id").cast("long").alias("__id")), RID)
    stays = named.groupBy("component_id").agg(
        F.min(F.struct(F.col("__id").isNull().alias("none"), "__id", RID)).alias("first"), F.count("*").alias("members"))
    stays = written(stays.filter("members > 1").select("component_id", "members", F.col(f"first.{RID}").alias("__stays")))
    gone = join_groups(groups, stays, ["component_id"], "members").filter(F.col(RID) != F.col("__stays")).select(F.col(RID).alias("doc_id"))
    return _without(docs, names, gone)


@_stage
def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a window of a benchmark item go."""
    from plyscope.llm.decontaminate import decontaminate
    docs, names = _numbered(docs)
    found = decontaminate(docs, table(spark, sf_dir, "benchmark"), id_col=RID)
    return _without(docs, names, found.filter("contaminated").select("doc_id"))


@_stage
def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets, and weak candidates linked with their complements, are replaced in the text by
    ``[SECRET]``; n_chars of such documents follows. No document goes."""
    from plyscope.llm.secrets import redact
    docs, names = _numbered(docs)
    clean = redact(docs)
    if "n_chars" in names:
        clean = clean.withColumn("n_chars", F.when(F.col("__redacted"), F.length("text").cast(docs.schema["n_chars"].dataType))
                                 .otherwise(F.col("n_chars")))
    return clean.select(*[F.col(f"`{c}`") for c in names])


@_stage
def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The remaining documents' token pieces and their places in sequences of 4096 tokens."""
    import public_tokenizers
    from plyscope.llm.packing import pack
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("ngram_jaccard", ngram_jaccard),
    ("benchmark_decontamination", benchmark_decontamination),
    ("secret_scan", secret_scan),
    ("best_fit_packing", best_fit_packing),
]

#: quality scores and token ids have no SQL form; the pipeline is tested against a plain version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each one's rows written and read back before the next."""
    docs, before = table(spark, sf_dir, "documents"), []
    for _, stage in STAGES[:-1]:
        with scope() as paths:
            docs = written(stage(spark, docs, sf_dir))
        free(spark, before)
        before = paths
    return STAGES[-1][1](spark, docs, sf_dir)
