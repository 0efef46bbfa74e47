"""The corpus pipeline: toxicity, line dedup, SimHash near-dedup, decontamination, mixing to target weights."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from bidscope.llm import decontaminate, line_dedup, mixing, simhash_dedup, toxicity
from bidscope.llm.common import table
from bidscope.session import scratch_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model scores below 0.5; it learns from the labelled rows of the corpus that are not held out.

    Null and empty texts get the score of a text without words, which is below.
    """
    labels = table(spark, sf_dir, "labels").where(~toxicity.held_out())
    model = toxicity.train(table(spark, sf_dir, "documents"), labels)
    return docs.where(toxicity.scorer(model)("text") < 0.5)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without later copies of line runs; documents of which nothing is left go, null and empty texts stay."""
    return line_dedup.without_repeated_lines(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by fingerprints of three-word shingles at two or fewer differing bits.

    Null texts, empty ones and texts without words are one group.
    """
    return simhash_dedup.drop_near_duplicates(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of the benchmark occurs; null and empty texts have none."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix in which the languages' expected tokens are equal: a row for each copy of a document, with its rate.

    A document at a rate below 1 is left out by a hash of its id, and one above 1 comes more than once.
    """
    return mixing.sampled(mixing.mix(docs, docs.where("lang IS NOT NULL"), "lang"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("simhash_dedup", drop_near_copies),
    ("decontaminate", drop_contaminated),
    ("mix", mix),
]

#: The toxicity model and the classifier of the mix are numpy and iteration; the stages are tested one by one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each one's rows are written to the shared folder for the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
