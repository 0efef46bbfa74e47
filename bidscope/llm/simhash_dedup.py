"""SimHash near-duplicates by deletion-variant signatures.

A 64-bit fingerprint is cut into two segments of 32 bits. Two fingerprints at two or fewer differing bits
agree in one segment but for at most one bit, so every pair shares either a whole segment or one with a
single bit wiped out. Those variants are the index: fingerprints meet by equality of a variant, and each
meeting is verified over all 64 bits.

Copies are one row before anything is indexed: the index holds distinct fingerprints. A variant shared by
two fingerprints gives its pair from the aggregate itself; one shared by up to ``BUCKET`` is joined; the
members of a fuller one go to ``_cliques``, which makes no pairs at all: fingerprints that agree outside two
wiped bits are within two bits of each other, so a star per such group holds every link between them.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from bidscope.llm.common import components, table
from bidscope.session import stage_table

SEED = 42
SHINGLE = 3
MAX_BITS = 2
#: Fingerprints under one variant that are joined pair by pair. Beyond it another exact way is taken.
BUCKET = 64
_CHUNK = 1 << 16


def simhash64(text: str | None, shingle: int = SHINGLE) -> int:
    """The fingerprint of a text as an unsigned integer; 0 where it has no words."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        shingles = [b" ".join(words)]
    else:
        shingles = [b" ".join(run) for run in zip(*(words[i:] for i in range(shingle)))]
    ones = np.zeros(64, dtype=np.int64)
    for start in range(0, len(shingles), _CHUNK):
        hashes = np.array([xxhash.xxh64_intdigest(s, SEED) for s in shingles[start : start + _CHUNK]], dtype="<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(shingles)).view("<u8")[0])


@F.pandas_udf(LongType())
def _fingerprint(texts: pd.Series) -> pd.Series:
    return pd.Series(np.array([simhash64(t) for t in texts], dtype="<u8").view(np.int64))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, fp`` of every row; a null text counts as an empty one."""
    return docs.select(F.col(id_col).alias("doc_id"), _fingerprint(F.col(text_col)).alias("fp"))


def as_hex(fp: str) -> Column:
    return F.lower(F.lpad(F.hex(F.col(fp)), 16, "0"))


def _variants(fps: DataFrame) -> DataFrame:
    """``key, side, fp``: a row per segment as it is (side 0) and per segment with one bit wiped out (side: the bit)."""
    rows = []
    for number in range(2):
        shift = 32 * number
        segment = F.shiftrightunsigned("fp", shift).bitwiseAND(F.lit(0xFFFFFFFF))
        name = number * 33
        rows.append(F.struct((F.lit((name + 32) << 32) + segment).alias("key"), F.lit(0).alias("side")))
        for bit in range(32):
            wiped = segment.bitwiseAND(F.lit(0xFFFFFFFF ^ (1 << bit)))
            side = F.shiftrightunsigned(segment, bit).bitwiseAND(F.lit(1)).cast("int")
            rows.append(F.struct((F.lit((name + bit) << 32) + wiped).alias("key"), side.alias("side")))
    return fps.select("fp", F.explode(F.array(*rows)).alias("v")).select("v.key", "v.side", "fp")


_WHOLE = "shiftright(key, 32) % 33 = 32"


def _near(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= MAX_BITS


def links(fps: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """Links ``u, v`` that join all distinct fingerprints (``fp``) within two bits, directly or over others.

    Every pair under a variant of at most ``bucket`` fingerprints is there; those under fuller variants are
    represented by stars with the same components.
    """
    variants = _variants(fps)
    keys = variants.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"), F.sum("side").alias("n1"), F.min("fp").alias("lo"), F.max("fp").alias("hi")
    )
    # A segment with a wiped bit serves pairs that differ in that bit; equal ones meet in the whole segment.
    met = f"n > 1 AND ({_WHOLE} OR (n1 > 0 AND n1 < n))"
    shared = stage_table(keys.where(met), "shared_variants")
    pairs = shared.where("n = 2").select(F.col("lo").alias("u"), F.col("hi").alias("v"))
    fuller = shared.where("n > 2").select(F.col("key").alias("k"), "n")
    if fuller.isEmpty():
        return pairs.where(_near("u", "v")).distinct()
    members = stage_table(variants.join(fuller, F.col("key") == F.col("k")).select("key", "side", "fp", "n"), "members")
    some = members.where(F.col("n") <= bucket).select("key", "side", "fp")
    left, right = some.toDF("key", "s", "u"), some.toDF("key2", "t", "v")
    joined = left.join(
        right,
        (F.col("key") == F.col("key2"))
        & F.expr(f"CASE WHEN {_WHOLE} THEN u < v ELSE s < t END")
        & _near("u", "v"),
    ).select("u", "v")
    crowded = stage_table(members.where(F.col("n") > bucket).select("fp").distinct(), "crowded")
    return pairs.where(_near("u", "v")).union(joined).union(_cliques(crowded)).distinct()


def _cliques(fps: DataFrame) -> DataFrame:
    """Star links over the groups of distinct fingerprints that agree outside two wiped bits.

    Such a group has four members at most, one for each setting of the two bits. So it is kept as the settings found, and
    its members follow from those: nothing is joined.
    """
    masks = F.array(*[F.lit(_signed((1 << i) | (1 << j))) for i in range(64) for j in range(i)])
    low = F.col("mask").bitwiseAND(-F.col("mask"))
    bits = [low, F.col("mask").bitwiseXOR(low)]
    setting = sum((F.col("fp").bitwiseAND(bit) != 0).cast("int") * (at + 1) for at, bit in enumerate(bits))
    groups = (
        fps.select("fp", F.explode(masks).alias("mask"))
        .select("mask", F.col("fp").bitwiseAND(F.bitwise_not("mask")).alias("rest"), setting.alias("setting"))
        .groupBy("mask", "rest")
        .agg(F.bit_or(F.expr("shiftleft(1, setting)")).alias("found"))
    )
    settings = [F.col("rest").bitwiseOR(bit) for bit in (F.lit(0), *bits, F.col("mask"))]
    members = F.array_compact(
        F.array(*[F.when(F.col("found").bitwiseAND(1 << at) != 0, one) for at, one in enumerate(settings)])
    )
    stars = groups.where(F.bit_count("found") > 1).select(members.alias("all"))
    return stars.select(F.explode(F.slice("all", 2, 3)).alias("u"), F.col("all")[0].alias("v"))


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bucket: int = BUCKET) -> DataFrame:
    """``doc_id, fingerprint, component_id`` of every row.

    A null text is an empty one; texts without words have fingerprint 0 and are linked like any other. The
    component is the smallest id reachable; rows with a null id are linked too and get the smallest id that is
    not null, or null where there is none. Repeated rows stay. An empty table gives no rows. Other columns of
    ``docs``, whatever their names, are not read.
    """
    rows = stage_table(fingerprints(docs, id_col, text_col), "fingerprints")
    # As many classes as distinct fingerprints: merged whatever their files' size, which is small for what they are.
    return rows.join(_classes(rows, bucket).hint("merge"), F.col("fp") == F.col("own")).select(
        "doc_id", as_hex("fp").alias("fingerprint"), "component_id"
    )


def _classes(rows: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """``own, root, component_id`` of each distinct fingerprint; the root is one of its component's fingerprints."""
    distinct = stage_table(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct_fingerprints")
    roots = components(links(distinct.select("fp"), bucket))
    rooted = stage_table(
        distinct.join(roots, F.col("fp") == F.col("vertex"), "left").select(
            "fp", "first", F.coalesce("root", "fp").alias("root")
        ),
        "rooted",
    )
    lowest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    return rooted.join(lowest, "root").select(F.col("fp").alias("own"), "root", "component_id")


def drop_near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bucket: int = BUCKET
) -> DataFrame:
    """``docs`` with one row of each component of ``near_duplicates``; all its columns stay.

    It is a row with the component's smallest id; of several such rows any one, and of a component without ids too.
    A null text is an empty one, and texts without words are copies of each other. An empty table stays empty.
    """
    rows = stage_table(fingerprints(docs, id_col, text_col), "fingerprints")
    classes = stage_table(_classes(rows, bucket), "classes")
    total, ids = rows.agg(F.count(F.lit(1)), F.countDistinct("doc_id")).first()
    if total == ids:
        # Ids tell rows apart, so the texts need no second fingerprint.
        packed = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("id"))
        kept = classes.select(F.col("component_id").alias("keep")).distinct()
        return packed.join(kept, F.col("id") == F.col("keep"), "left_semi").select("row.*")
    packed = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("id"), _fingerprint(F.col(text_col)).alias("fp"))
    first = packed.join(classes.hint("merge"), (F.col("fp") == F.col("own")) & F.col("id").eqNullSafe(F.col("component_id")))
    return first.dropDuplicates(["root"]).select("row.*")


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
