"""The ETL run by increments: what arrives is merged, and only the dates it touches are aggregated again.

Facts and snapshots are versioned tables, partitioned by date. A load's name is committed together with its rows, so a load
that is delivered again changes nothing. Each snapshot notes which version of a date's facts it was computed from; a run
brings those dates up to date whose facts are newer. A run that failed anywhere is mended by repeating it, and a bid that
moved to another date touches both.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bidscope.functions.columns import put
from bidscope.operators.enrich import derive_auction_columns, scored_against
from bidscope.operators.snapshots import DAILY_GRAIN, HOURLY_GRAIN, kpi_snapshot, largest_groups
from bidscope.session import stage_table
from bidscope.sources.versioned import VersionedStore

FACTS = "fact_auctions"
GRAINS = {"kpi_daily": DAILY_GRAIN, "kpi_hourly": HOURLY_GRAIN}
MOMENTS = "bid_moments"


def add_load(store: VersionedStore, name: str, auctions: DataFrame) -> bool:
    """Merge raw auctions into the facts by their id; False where the load of that name was merged before.

    The facts have the columns that a row gives by itself; what compares a bid with all others is added by ``enriched_facts``.
    """
    facts = derive_auction_columns(auctions)
    now = store.version(FACTS)
    if now is None:
        store.load(facts, FACTS, partition_by=["date"], notes={"loads": [name]})
        return True
    if name in now.notes["loads"]:
        return False
    store.merge(facts, FACTS, ["auction_id"], notes={"loads": [*now.notes["loads"], name]})
    return True


def stale_dates(store: VersionedStore, table: str) -> list[str]:
    """The partitions whose facts are not those that ``table`` was computed from."""
    facts, derived = store.version(FACTS), store.version(table)
    made_from = {} if derived is None else derived.notes["facts"]
    now = {part: list(loads) for part, loads in facts.parts.items()}
    return sorted(part for part in now.keys() | made_from.keys() if now.get(part) != made_from.get(part))


def refresh(store: VersionedStore) -> dict[str, int]:
    """Bring every derived table up to the facts; the number of dates each had to compute again."""
    computed = {}
    stale = {table: stale_dates(store, table) for table in (*GRAINS, MOMENTS)}
    facts = store.version(FACTS)
    source = {"facts": {part: list(loads) for part, loads in facts.parts.items()}}
    for table, parts in stale.items():
        computed[table] = len(parts)
        if not parts:
            continue
        rows = store.table(FACTS, facts.number, parts)
        store.replace_parts(_derived(rows, table), table, parts, ["date"], source)
    return computed


def _derived(rows: DataFrame, table: str) -> DataFrame:
    if table in GRAINS:
        (largest,) = largest_groups(rows, [GRAINS[table]])
        return kpi_snapshot(rows, GRAINS[table], largest=largest)
    bid = F.col("winning_bid_usd")
    return rows.dropna(subset=["placement_type"]).groupBy("date", "placement_type").agg(
        F.count(bid).alias("n"), F.avg(bid).alias("mean"), (F.var_pop(bid) * F.count(bid)).alias("squares")
    )


def run_incremental(store: VersionedStore, name: str, auctions: DataFrame) -> dict[str, int]:
    """Merge a load and refresh what depends on it; the number of dates computed again per table.

    Rows without a date are kept with the facts and are in no snapshot.
    """
    add_load(store, name, auctions)
    return refresh(store)


def placement_statistics(store: VersionedStore) -> DataFrame:
    """Mean and deviation of the bids of each placement, from the moments of its dates; no fact is read."""
    days = stage_table(store.table(MOMENTS).where("n > 0"), "moments")
    means = days.groupBy("placement_type").agg((F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("_mean"))
    off = F.col("mean") - F.col("_mean")
    merged = days.join(means, "placement_type").groupBy("placement_type", "_mean").agg(
        F.sum("n").alias("_n"), F.sum(F.col("squares") + F.col("n") * off * off).alias("_squares")
    )
    return put(merged, {"_std": "sqrt(_squares / nullif(_n - 1, 0))"}).select("placement_type", "_mean", "_std")


def enriched_facts(store: VersionedStore, parts: Sequence[str] | None = None) -> DataFrame:
    """The facts, or some of their dates, with the z-score of each bid over all facts of its placement."""
    return scored_against(store.table(FACTS, parts=parts), stage_table(placement_statistics(store), "statistics"))
