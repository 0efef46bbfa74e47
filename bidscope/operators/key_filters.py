"""Bloom filters of the keys that a table's partitions hold, so that an append is checked without reading the whole table.

A filter is rows ``<partition columns>, block, lane_0 .. lane_7``: a key falls into one of ``blocks`` blocks and sets one of 64
bits in each of its eight lanes. Building is one grouped aggregate of bits, so filters of two loads merge by the same
aggregate, and a hot partition is many blocks. A key that may be stored has all eight bits set.

Filters of one table must have the same number of blocks.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bidscope.session import stage_table

LANES = [f"lane_{i}" for i in range(8)]
#: Keys a block is meant for: 32 bits a key, and about one wrong hit in 170,000 looks at a full partition.
KEYS_PER_BLOCK = 16


def blocks_for(keys: int) -> int:
    """How many blocks suit a partition of that many keys."""
    return max(1, -(-keys // KEYS_PER_BLOCK))


def _complete(key: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(name).isNotNull() for name in key])


def _placed(key: Sequence[str], blocks: int) -> dict[str, Column]:
    """The block of a key, and the bit that it sets in each lane."""
    spot = F.pmod(F.xxhash64(F.lit("block"), *key), F.lit(blocks).cast("long"))
    bits = F.xxhash64(F.lit("bits"), *key)
    six = [F.shiftright(bits, 6 * i).bitwiseAND(63).cast("int") for i in range(len(LANES))]
    return {"block": spot} | {lane: F.call_function("shiftleft", F.lit(1).cast("long"), at) for lane, at in zip(LANES, six)}


def build_filters(df: DataFrame, key: Sequence[str], by: Sequence[str], blocks: int) -> DataFrame:
    """The filters of the partitions of ``df``. Rows that lack a part of the key set no bit; null partitions are one."""
    bits = df.where(_complete(key)).select(*by, *[column.alias(name) for name, column in _placed(key, blocks).items()])
    return _or(bits, by)


def merge_filters(filters: Sequence[DataFrame], by: Sequence[str]) -> DataFrame:
    """The filters of several loads as one."""
    return _or(reduce(DataFrame.unionByName, filters), by)


def _or(bits: DataFrame, by: Sequence[str]) -> DataFrame:
    return bits.groupBy(*by, "block").agg(*[F.bit_or(lane).alias(lane) for lane in LANES])


def possible_hits(new: DataFrame, filters: DataFrame, key: Sequence[str], by: Sequence[str], blocks: int) -> DataFrame:
    """``key`` and ``stored_<partition column>``: which partitions may hold the keys of ``new``, never one too few.

    Where ``by`` is part of the key, only the partition of the key itself can hold it, and is looked at alone. Otherwise each
    new key is held against its block in every partition, in the join, and only hits become rows.
    """
    wanted = new.where(_complete(key)).select(*key).distinct()
    placed = _placed(key, blocks)
    looked = wanted.select(*key, *[column.alias(f"_{name}") for name, column in placed.items()])
    stored = filters.withColumnsRenamed({name: f"stored_{name}" for name in by})
    on = [F.col("_block") == F.col("block")] + [F.col(name) == F.col(f"stored_{name}") for name in by if name in key]
    for lane in LANES:
        on.append(F.col(lane).bitwiseAND(F.col(f"_{lane}")) != 0)
    return looked.join(stored, reduce(lambda a, b: a & b, on)).select(*key, *[f"stored_{name}" for name in by])


def check_append(
    new: DataFrame,
    stored: DataFrame,
    filters: DataFrame,
    table: str,
    key: Sequence[str],
    by: Sequence[str],
    blocks: int,
) -> DataFrame:
    """What an append of ``new`` to ``stored`` does to the keys, in one row like ``quality.check_primary_key``.

    ``repeated_keys`` are keys of ``new`` that come more than once in both together, ``rows_with_repeated_key`` their rows in
    both, ``rows_without_key`` the rows of ``new`` that lack a key, ``partitions_read`` the partitions of ``stored`` that had to
    be read and ``partitions_stored`` all that have keys. Only these partitions are read, of them only key and partition, and
    only rows whose key may be among the new ones are counted. ``filters`` must cover ``stored``. Keys already repeated in
    ``stored`` and absent from ``new`` are not looked for.
    """
    key, by = list(key), list(by)
    hits = stage_table(possible_hits(new, filters, key, by, blocks), "possible-hits")
    # One row per partition, as many as the reader lists anyway.
    parts = hits.select(*[F.col(f"stored_{name}").alias(name) for name in by]).distinct().collect()
    counted = new.groupBy(*key).agg(F.count(F.lit(1)).alias("_new"))
    read = stored.where(_within(parts, by)).select(*dict.fromkeys([*key, *by]))
    # A count per key in front of the join: a key that is stored very often is a row.
    held = read.where(_complete(key)).join(hits.select(*key).distinct(), key, "left_semi")
    held = held.groupBy(*key).agg(F.count(F.lit(1)).alias("_held"))
    both = counted.join(held, key, "left").withColumn("_n", F.col("_new") + F.coalesce("_held", F.lit(0)))
    lacking, repeated = ~_complete(key), (F.col("_n") > 1) & _complete(key)
    return both.agg(
        F.lit(table).alias("table_name"),
        F.lit(", ".join(key)).alias("key_columns"),
        F.count_if(repeated).alias("repeated_keys"),
        F.coalesce(F.sum(F.when(repeated, F.col("_n"))), F.lit(0)).alias("rows_with_repeated_key"),
        F.coalesce(F.sum(F.when(lacking, F.col("_new"))), F.lit(0)).alias("rows_without_key"),
        F.lit(len(parts)).cast("long").alias("partitions_read"),
        filters.select(F.count_distinct(F.struct(*by)).alias("n")).scalar().alias("partitions_stored"),
    )


def _within(parts: Sequence, by: Sequence[str]) -> Column:
    """A condition on the partition columns alone, which prunes folders."""
    if len(by) == 1:
        values = [part[0] for part in parts if part[0] is not None]
        found = F.col(by[0]).isin(values) if values else F.lit(False)
        return found | F.col(by[0]).isNull() if len(values) < len(parts) else found
    one = [reduce(lambda a, b: a & b, [F.col(name).eqNullSafe(F.lit(value)) for name, value in zip(by, part)]) for part in parts]
    return reduce(lambda a, b: a | b, one, F.lit(False))
