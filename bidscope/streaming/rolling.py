"""Adaptive limits on a stream of bids: each against the bids of its placement right before it.

What a trigger needs of the past is the last bids of each placement. They are written beside the results, below the
trigger's number, and read by the next trigger, which numbers, cuts into chunks and rolls old and new bids together as a
batch does. A hot placement is therefore many tasks, the state is as large as the look-back whatever came before, and a
trigger that is repeated after a failure reads and writes the same.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bidscope.operators.detect import BID_Z_THRESHOLD, CHUNK_ROWS, ROLLING_ROWS, in_bid_order, rolled
from bidscope.session import stage_table

_BID = ("auction_id", "placement_type", "timestamp", "winning_bid_usd")


def roll_stream(
    bids: DataFrame,
    location: str,
    rows_back: int = ROLLING_ROWS,
    chunk_rows: int = CHUNK_ROWS,
    z_threshold: float = BID_Z_THRESHOLD,
) -> None:
    """Run the stream over all there is, from where the last run with this ``location`` ended.

    Results are ``rolling_baseline``'s for bids that come in the order of time. A late bid is rolled over the bids before
    it that are still kept, none if it is older than these; it counts for the bids that come after it, and results
    that were written stay as they are.
    """
    spark = bids.sparkSession

    def write(batch: DataFrame, number: int) -> None:
        new = batch.select(*_BID, F.lit(True).alias("_new"))
        if number:
            new = new.union(spark.read.schema(batch.select(*_BID).schema).parquet(f"{location}/last/batch={number - 1}").select(*_BID, F.lit(False)))
        placed = in_bid_order(new, ["_new"])
        flags = rolled(placed, rows_back, chunk_rows, z_threshold, ["_new"]).where("_new").drop("_new")
        flags.write.mode("overwrite").parquet(f"{location}/flags/batch={number}")
        ends = stage_table(placed.groupBy("placement_type").agg(F.max("_position").alias("_end")), "ends")
        last = placed.join(ends, "placement_type").where(F.col("_position") > F.col("_end") - rows_back)
        last.select(*_BID).write.mode("overwrite").parquet(f"{location}/last/batch={number}")

    query = (
        bids.writeStream.foreachBatch(write)
        .option("checkpointLocation", f"{location}/state")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def rolled_flags(spark: SparkSession, location: str) -> DataFrame:
    """Everything that ``roll_stream`` wrote."""
    return spark.read.parquet(f"{location}/flags").drop("batch")
