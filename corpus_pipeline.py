"""Training text from raw documents: five stages, each one operator of ``rosterloom.llm``.

A stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the
next one's docs.  All but the last return the columns they were given; columns a stage does not
know are carried along untouched, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterloom.llm import decontaminate, lines, packing, quality, simhash
from rosterloom.session import tune
from rosterloom.sources.staging import discard, staging_path


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _carried(docs: DataFrame) -> DataFrame:
    """doc_id and text for an operator, the whole row in a column that no operator's names can touch."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), "doc_id", "text")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rule or a learned one go."""
    rules = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.judge(_carried(docs), rules).where("kept").select("_row.*")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that a document with a smaller id holds too go; n_chars, if there, follows the text."""
    found = lines.dedupe_lines(_carried(docs))
    new = {"text": F.col("lines.kept"), "n_chars": F.length("lines.kept")}
    kinds = dict(docs.dtypes)
    return found.select(*[new[c].cast(kinds[c]).alias(c) if c in new else F.col(f"_row.`{c}`") for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id stays."""
    return simhash.keep_one(_carried(docs)).select("_row.*")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    scanned = decontaminate.scan(_carried(docs), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return decontaminate.drop_contaminated(scanned).select("_row.*")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The remaining documents as pieces of sequences."""
    return packing.report(packing.pack(docs))


def _tuned(stage: Stage) -> Stage:
    """The stage under the runtime settings of this library, which bound what a Python worker holds."""

    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        return stage(tune(spark), docs, sf_dir)

    return run_stage


STAGES = [
    ("quality_rules", _tuned(quality_rules)),
    ("line_dedup", _tuned(line_dedup)),
    ("near_duplicates", _tuned(near_duplicates)),
    ("decontamination", _tuned(decontamination)),
    ("packing", _tuned(pack)),
]

#: The first stage learns its rules from labels, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what lies between two stages is written to the shared folder.

    A stage's table goes once the next one is written; the last is read by the result and stays.
    """
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        path = staging_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            discard(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
