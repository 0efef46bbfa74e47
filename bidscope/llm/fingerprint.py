"""Document fingerprints by a threshold-scaled sketch, and the likeness of neighbours in id order.

A fingerprint is every shingle hash below a fixed fraction of the hash range. Sketches of one fraction can be
united, and intersected to estimate containment however unequal the documents are. A text with shingles but no
hash below the threshold keeps its smallest one, so that only a text without words has an empty fingerprint.

The neighbour of a document is the next in descending id order. Ids are cut into ranges by quantiles; each
range is sorted in a task that holds two texts at a time, and also gets the first document of the range behind it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bidscope.llm.common import table

#: Words in a shingle.
SHINGLE = 5
#: One hash in this many is kept.
SCALE = 8
#: Id ranges per shuffle partition: several, so that hashing ranges to partitions stays even.
_RANGES = 8
_SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double, contained_edited double, contained_next double"
)


def sketch(text: str | None, shingle: int = SHINGLE, scale: int = SCALE) -> frozenset[int]:
    """The kept hashes of the shingles of lower-cased words; a shorter text is one shingle."""
    words = (text or "").lower().encode("utf-8", "surrogatepass").split()
    if not words:
        return frozenset()
    if len(words) <= shingle:
        return frozenset([xxhash.xxh64_intdigest(b" ".join(words))])
    below = (1 << 64) // scale
    digest, join = xxhash.xxh64_intdigest, b" ".join
    hashes = [digest(join(run)) for run in zip(*(words[i:] for i in range(shingle)))]
    kept = frozenset(h for h in hashes if h < below)
    return kept or frozenset([min(hashes)])


def as_text(hashes: frozenset[int]) -> str:
    """Sixteen hex digits per hash, in ascending order."""
    return np.sort(np.fromiter(hashes, dtype=np.uint64, count=len(hashes))).astype(">u8").tobytes().hex()


def from_text(fingerprint: str) -> frozenset[int]:
    return frozenset(int(fingerprint[i : i + 16], 16) for i in range(0, len(fingerprint), 16))


def likeness(a: frozenset[int], b: frozenset[int]) -> float:
    """Estimated Jaccard similarity; two empty fingerprints are alike."""
    union = len(a | b)
    return len(a & b) / union if union else 1.0


def containment(a: frozenset[int], b: frozenset[int]) -> float:
    """Estimated share of the shingles of ``a`` that ``b`` has; an empty one is contained in any."""
    return len(a & b) / len(a) if a else 1.0


def _compare(rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows come sorted by range, then neighbour's rows last, then descending id."""
    before = None  # range, id, text, sketch of the row whose neighbour comes next
    for batch in rows:
        out = []
        for part, guest, doc_id, text in batch[["part", "guest", "doc_id", "body"]].itertuples(index=False, name=None):
            if guest and (before is None or before[0] != part):
                continue
            own = sketch(text)
            if before is not None and before[0] == part:
                out.append(_result(*before[1:], text, own))
            before = None if guest else (part, doc_id, text, own)
        yield pd.DataFrame(out, columns=[c.split()[0] for c in _SCHEMA.split(", ")]).astype({"doc_id": "Int64"})


def _result(doc_id: int | None, text: str, own: frozenset[int], next_text: str, following: frozenset[int]) -> tuple:
    half = len(text) // 2
    edited_text = text[: len(text) - half] + next_text[:half]
    edited = sketch(edited_text)
    return (
        None if pd.isna(doc_id) else int(doc_id),
        len(text),
        hashlib.sha256(edited_text.encode()).hexdigest(),
        as_text(own),
        as_text(edited),
        likeness(own, edited),
        likeness(own, following),
        containment(own, edited),
        containment(own, following),
    )


def _range_of(bounds: list[int]) -> Column:
    """How many bounds are below the id: a coarse step over every k-th bound, a fine one between two of them."""
    if not bounds:
        return F.when(F.col("doc_id").isNull(), -1).otherwise(0)
    step = max(1, int(len(bounds) ** 0.5))
    known, coarse = F.array(*map(F.lit, bounds)), F.array(*map(F.lit, bounds[step - 1 :: step] or bounds[-1:]))
    whole = F.size(F.filter(coarse, lambda b: b < F.col("doc_id"))) * step
    rest = F.size(F.filter(F.slice(known, whole + 1, F.lit(step)), lambda b: b < F.col("doc_id")))
    return F.when(F.col("doc_id").isNull(), -1).otherwise(whole + rest)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per row of ``docs`` with its fingerprint and its likeness to the edited text and the next document.

    A null text is an empty one. Rows that share an id follow each other in the order of their texts' hashes, rows
    with a null id come last; after the last row comes the first again, and the only row is its own neighbour. An
    empty table gives no rows. Other columns are not read.
    """
    spark = docs.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ids = docs.select(F.col(id_col).cast("long").alias("doc_id"))
    shares = [k / (_RANGES * partitions) for k in range(1, _RANGES * partitions)]
    cut = ids.agg(F.percentile_approx("doc_id", shares, 100 * len(shares) + 10_000)).first()[0] or []
    bounds = sorted(set(cut))  # as many as there are ranges, whatever the number of rows
    part = _range_of(bounds)
    heads = ids.withColumn("part", part).groupBy("part").agg(F.max("doc_id").alias("head"))
    first = {r["part"]: r["head"] for r in heads.collect()}  # a row per range
    if not first:
        return spark.createDataFrame([], _SCHEMA)
    order = sorted(first, reverse=True)
    before = {p: order[i - 1] for i, p in enumerate(order)}
    slots = range(-1, len(bounds) + 1)
    head_of = F.get(F.array(*[F.lit(first.get(p)).cast("long") for p in slots]), F.col("part") + 1)
    before_it = F.get(F.array(*[F.lit(before.get(p)).cast("int") for p in slots]), F.col("part") + 1)
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("body")
    ).withColumn("part", part)
    host = F.struct(F.col("part").alias("part"), F.lit(False).alias("guest"))
    guest = F.struct(before_it.alias("part"), F.lit(True).alias("guest"))
    is_head = F.col("doc_id").eqNullSafe(head_of)
    sent = rows.select("doc_id", "body", F.explode(F.when(is_head, F.array(host, guest)).otherwise(F.array(host))).alias("to"))
    dealt = sent.select("to.part", "to.guest", "doc_id", "body").repartition(partitions, "part")
    placed = dealt.sortWithinPartitions("part", "guest", F.col("doc_id").desc_nulls_last(), F.xxhash64("body"), "body")
    return placed.mapInPandas(_compare, _SCHEMA)


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))
