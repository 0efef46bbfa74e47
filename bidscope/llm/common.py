"""What several operators of this package share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bidscope.session import stage_table

A_TO_Z = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    """Only A-Z become lower case; other letters stay as they are."""
    return F.translate(text, A_TO_Z, A_TO_Z.lower())


def crc_of_id(doc_id: str | Column = "doc_id") -> Column:
    """crc32 of the id written as text."""
    return F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id.cast("string"))


def bounded_sample(rows: DataFrame, key: Column, bound: int) -> DataFrame:
    """About ``bound`` rows at most, drawn by a hash of ``key``; all rows where there are fewer.

    The draw depends on the keys alone, so a repeated run draws the same rows. Null keys count as one key. It has
    twelve digits, so that a share far below one in a million is drawn too.
    """
    total = rows.count()
    if total <= bound:
        return rows
    return rows.where(_draw(key) < 1e6 * bound / total)


def _draw(key: Column) -> Column:
    digits = [F.pmod(F.xxhash64(F.lit(salt), key), F.lit(1_000_000)) for salt in ("draw", "finer draw")]
    return digits[0] + digits[1] / 1e6


def bounded_sample_per_class(rows: DataFrame, of: str, key: Column, bound: int, least: int) -> DataFrame:
    """``bounded_sample``, but of each value of ``of`` about ``least`` rows at least, all where there are fewer.

    About ``bound`` rows and ``least`` for each rare class at most. Rows without a class are left out. The rows of frequent
    classes are those that ``bounded_sample`` draws.
    """
    known = rows.where(F.col(of).isNotNull())
    counts = known.groupBy(of).agg(F.count(F.lit(1)).alias("n")).collect()  # a row per class
    total = sum(r["n"] for r in counts)
    if total <= bound:
        return known
    share = F.lit(bound / total)
    for r in counts:
        if r["n"] * bound < least * total:
            share = F.when(F.col(of) == r[of], min(1.0, least / r["n"])).otherwise(share)
    return known.where(_draw(key) < 1e6 * share)


def components(edges: DataFrame, stage: Callable[[DataFrame, str], DataFrame] = stage_table) -> DataFrame:
    """The connected component of each vertex of ``edges`` (u, v: longs): columns ``vertex, root``.

    The root is the smallest vertex. Large-star and small-star steps alternate until every vertex points
    at its root; each step is a partially aggregated minimum per vertex and a join, so a vertex with very
    many links is split by the adaptive skew join and never gathered. Both are cut off in the shared folder.
    """
    ordered = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    now = stage(ordered.distinct(), "edges")
    mark = _mark(now)
    while True:
        now = stage(_small_star(stage(_large_star(now), "large_star")), "small_star")
        before, mark = mark, _mark(now)
        if mark == before:
            break
    roots = now.groupBy("u").agg(F.min("v").alias("root")).select(F.col("u").alias("vertex"), "root")
    return roots.union(now.select("v", "v").distinct().toDF("vertex", "root"))


def _mark(edges: DataFrame) -> tuple:
    return tuple(
        edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()  # type: ignore[arg-type]
    )


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("v", "u"))
    lowest = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("c"), F.least("u", "m").alias("m"))
    linked = both.where("v > u").join(lowest, F.col("u") == F.col("c"))
    return linked.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    lowest = edges.groupBy("u").agg(F.min("v").alias("m"))
    linked = edges.join(lowest.select(F.col("u").alias("c"), "m"), F.col("u") == F.col("c"))
    moved = linked.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(lowest.select("u", "m")).distinct()
