"""Isolation forest (Liu, Ting and Zhou, 2008) with sampling and scoring spread over the cluster.

A row is drawn for a tree by a hash of its id and the tree, in the task that reads it; about
``2 * sample_rows`` rows a tree, whatever the data, are ever grouped, and one tree grows on
``sample_rows`` of them. All rows are scored in Arrow batches.

Every draw and every cut follows from the MD5 of a text, and depths are whole billionths, so the same rows give the same
forest and the same scores in any engine and in any order.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bidscope.functions.numbers import ratio, round_mean
from bidscope.operators.quantiles import grouped_quantiles
from bidscope.operators.tree_tables import NODES, ensemble_sum, with_ensemble_sum
from bidscope.session import stage_table

# Default features and settings.
FEATURES = [
    "winning_bid_usd",
    "clearing_price_usd",
    "bid_spread",
    "ecpm",
    "auction_depth",
    "bid_floor_usd",
]
TREES = 100
SAMPLE_ROWS = 256
CONTAMINATION = 0.02

_NODES = T.StructType(
    [
        T.StructField("tree", T.IntegerType()),
        T.StructField("node", T.IntegerType()),
        T.StructField("feature", T.IntegerType()),
        T.StructField("cut", T.DoubleType()),
        T.StructField("depth", T.LongType()),
    ]
)
#: Draws are whole numbers below this: ten hexadecimal digits of an MD5.
SPAN = 1 << 40
BILLION = 10**9


def expected_depth(rows: float) -> float:
    """Mean depth of an unsuccessful search in a binary search tree of ``rows`` keys."""
    if rows <= 1:
        return 0.0
    if rows == 2:
        return 1.0
    return 2.0 * (math.log(rows - 1.0) + np.euler_gamma) - 2.0 * (rows - 1.0) / rows


def drawn(*salt: object) -> int:
    """A whole number below ``SPAN`` that follows from the salt."""
    return int(hashlib.md5("|".join(map(str, salt)).encode()).hexdigest()[:10], 16)


def digits_of(*salt: Column) -> Column:
    """``drawn`` of every row as its ten digits: they sort and compare as the number does, and need no conversion."""
    return F.substring(F.md5(F.concat_ws("|", *[column.cast("string") for column in salt])), 1, 10)


def below(digits: Column, share: float) -> Column:
    """Whether a draw is in the first ``share`` of the span."""
    limit = int(share * SPAN)
    return F.lit(True) if limit >= SPAN else digits < f"{limit:010x}"


def leaf_depth(level: int, rows: int) -> int:
    """How deep a row of a leaf is expected to be, in billionths."""
    return level * BILLION + math.floor(expected_depth(rows) * BILLION + 0.5)


def grow_tree(x: np.ndarray, tree: int, seed: int, levels: int) -> list[tuple[int, int, float, int]]:
    """Nodes of one tree in heap order: children of ``i`` are ``2i + 1`` and ``2i + 2``.

    A node is cut at a drawn place between the least and the greatest value of one drawn feature that varies in it.
    """
    nodes = []
    waiting = [(0, 0, x)]
    while waiting:
        node, level, rows = waiting.pop()
        usable = np.flatnonzero(rows.max(axis=0) > rows.min(axis=0)) if len(rows) > 1 else []
        if level == levels or len(usable) == 0:
            nodes.append((node, -1, math.inf, leaf_depth(level, len(rows))))
            continue
        feature = int(usable[drawn("feature", tree, node, seed) % len(usable)])
        column = rows[:, feature]
        low, high = float(column.min()), float(column.max())
        cut = low + (drawn("cut", tree, node, seed) + 0.5) / SPAN * (high - low)
        below = column < cut
        nodes.append((node, feature, cut, 0))
        waiting += [(2 * node + 1, level + 1, rows[below]), (2 * node + 2, level + 1, rows[~below])]
    return nodes


class AnomalyForest:
    """Fit on one frame, then score any frame with the same features."""

    def __init__(
        self,
        contamination: float = CONTAMINATION,
        trees: int = TREES,
        sample_rows: int = SAMPLE_ROWS,
        features: Sequence[str] = FEATURES,
        seed: int = 42,
        native: bool = False,
    ):
        """``native`` scores by Spark's own expressions instead of numpy in Arrow batches; both reach the same leaves."""
        self.native = native
        self.contamination = contamination
        self.trees = trees
        self.sample_rows = sample_rows
        self.candidates = list(features)
        self.seed = seed
        self.features: list[str] = []
        self.medians: dict[str, float] = {}
        self.scales: dict[str, tuple[float, float]] = {}
        self.threshold: float | None = None
        self._nodes = None
        self._grown: pd.DataFrame | None = None
        self._sampled = 0

    def fit(self, df: DataFrame, id_col: str = "auction_id") -> AnomalyForest:
        """Grow the trees and set the threshold at the scores' quantile."""
        doubles = self._grow_on(df, id_col)
        self._limit(stage_table(self._scored(doubles).select("_score"), "forest-scores"))
        return self

    def fit_predict(self, df: DataFrame, id_col: str = "auction_id") -> DataFrame:
        """``predict`` of the rows the forest is fitted on; each row is scored once."""
        self._grow_on(df, id_col)
        scored = stage_table(self._scored(df), "forest-scored")
        self._limit(scored)
        return self._flagged(scored)

    def _grow_on(self, df: DataFrame, id_col: str) -> DataFrame:
        """Medians, scales and trees of the rows; returns their id and features, staged."""
        self.features = [name for name in self.candidates if name in df.columns]
        doubles = stage_table(
            df.select(id_col, *[F.col(name).cast("double").alias(name) for name in self.features]), "forest-features"
        )
        medians = grouped_quantiles(
            doubles.unpivot([id_col], self.features, "feature", "value"), ["feature"], "value", {"median": 0.5}
        )
        self.medians = {row["feature"]: row["median"] for row in medians.collect()}
        filled = {name: F.coalesce(F.col(name), F.lit(self.medians.get(name, 0.0))) for name in self.features}
        stats = doubles.agg(
            F.count(F.lit(1)).alias("rows"),
            *[F.avg(column).alias(f"mean_{name}") for name, column in filled.items()],
            *[F.stddev_pop(column).alias(f"std_{name}") for name, column in filled.items()],
        ).first()
        if not stats["rows"]:
            raise ValueError("The forest needs rows to grow on.")
        self.scales = {name: (stats[f"mean_{name}"], stats[f"std_{name}"] or 1.0) for name in self.features}
        sample = self._tree_samples(doubles, id_col, stats["rows"])
        self._grow(sample, min(self.sample_rows, stats["rows"]))
        return doubles

    def _limit(self, scored: DataFrame) -> None:
        limit = grouped_quantiles(scored, [], "_score", {"limit": 1.0 - self.contamination})
        self.threshold = limit.first()["limit"]

    def predict(self, df: DataFrame) -> DataFrame:
        """Add ``anomaly_score`` (higher is stranger) and ``is_anomaly``."""
        self._check_fitted()
        return self._flagged(self._scored(df))

    def _flagged(self, scored: DataFrame) -> DataFrame:
        return (
            scored.withColumn("anomaly_score", F.round("_score", 4))
            .withColumn("is_anomaly", F.col("_score") > self.threshold)
            .drop("_score")
        )

    def training_statistics(self, spark: SparkSession) -> DataFrame:
        """The median that fills gaps, mean and standard deviation of each feature."""
        self._check_fitted()
        lines = [(name, self.medians.get(name), *self.scales[name]) for name in self.features]
        return spark.createDataFrame(lines, "feature string, median double, mean double, std double")

    def summary(self, df: DataFrame) -> DataFrame:
        return summarise(self.predict(df))

    def _filled(self, name: str) -> Column:
        """A feature with its missing values at the median of the training rows.

        Not standardised: a cut between two values parts the same rows on any scale.
        """
        return F.coalesce(F.col(name).cast("double"), F.lit(self.medians.get(name, 0.0))).alias(name)

    def _tree_samples(self, doubles: DataFrame, id_col: str, rows: int) -> DataFrame:
        """About twice ``sample_rows`` rows per tree: by hash a pool for all trees, and from it each tree's.

        Both are conditions on the row, so every task emits its own hits and nothing is sorted or cut.
        """
        pool_rows = self.trees * self.sample_rows
        kept, share = min(1.0, pool_rows / rows), min(1.0, 2.0 * self.sample_rows / min(pool_rows, rows))
        own, seed = F.col(id_col), F.lit(self.seed)
        trees = F.sequence(F.lit(0), F.lit(self.trees - 1))
        hits = F.filter(
            F.transform(trees, lambda t: F.struct(t.alias("tree"), digits_of(own, t, seed).alias("_draw"))),
            lambda hit: below(hit["_draw"], share),
        )
        pool = doubles.where(below(digits_of(own, seed), kept))
        taken = pool.select(F.explode(hits).alias("_hit"), *[self._filled(name) for name in self.features])
        return taken.select("_hit.*", *self.features)

    def _grow(self, sample: DataFrame, sampled: int) -> None:
        features, seed, wanted = list(self.features), self.seed, self.sample_rows
        levels = max(1, math.ceil(math.log2(max(sampled, 2))))

        def grow(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
            tree = int(key[0])
            chosen = rows.sort_values(["_draw", *features])[features].to_numpy()[:wanted]
            nodes = grow_tree(chosen, tree, seed, levels)
            return pd.DataFrame([(tree, *node) for node in nodes], columns=[f.name for f in _NODES])

        # At most 2 * 256 nodes a tree, however large the data.
        nodes = sample.groupBy("tree").applyInPandas(grow, _NODES).toPandas()
        self._grown = nodes
        inner = 2**levels - 1
        feature = np.zeros((self.trees, inner), dtype=np.int32)
        cut = np.full((self.trees, inner), np.inf)
        depth = np.zeros((self.trees, inner + 1), dtype=np.int64)
        for tree, node, of, at, reached in nodes.itertuples(index=False):
            if of >= 0:
                feature[tree, node], cut[tree, node] = of, at
                continue
            # Nothing is beyond an infinite cut, so rows of a leaf fall to its leftmost place below.
            while node < inner:
                node = 2 * node + 1
            depth[tree, node - inner] = reached
        self._nodes = (feature, cut, depth, levels)
        self._sampled = sampled

    def tree_table(self, spark: SparkSession) -> DataFrame:
        """The trees as a table of nodes over ``features``, see ``tree_tables``; values are depths in billionths."""
        if self._grown is None:
            raise RuntimeError("The forest has not been grown yet.")
        grown = self._grown
        leaf = grown["feature"] < 0
        table = pd.DataFrame(
            {
                "tree": grown["tree"],
                "node": grown["node"],
                "feature": grown["feature"],
                # Below the cut is at most the next smaller number.
                "cut": np.where(leaf, 0.0, np.nextafter(grown["cut"], -np.inf)),
                "left": 2 * grown["node"] + 1,
                "right": 2 * grown["node"] + 2,
                "value": np.where(leaf, grown["depth"], 0).astype("float64"),
            }
        )
        return spark.createDataFrame(table, NODES)

    def score(self) -> Column:
        """The anomaly score as a column over the feature columns."""
        feature, cut, depth, levels = self._nodes
        typical = self._typical()
        filled = [self._filled(name) for name in self.features]
        if self.native:
            return self._strangeness(ensemble_sum(self.tree_table(SparkSession.getActiveSession()), filled))

        @F.pandas_udf(T.DoubleType())
        def forest_score(*columns: pd.Series) -> pd.Series:
            x = np.column_stack([column.to_numpy(dtype="float64") for column in columns])
            cells, row_start = x.ravel(), np.arange(len(x)) * x.shape[1]
            total = np.zeros(len(x), dtype=np.int64)
            for of_tree, cut_at, depth_at in zip(feature, cut, depth):
                at = np.zeros(len(x), dtype=np.int64)
                for _ in range(levels):
                    beyond = cells.take(row_start + of_tree.take(at)) >= cut_at.take(at)
                    at = 2 * at + 1 + beyond
                total += depth_at.take(at - len(of_tree))
            return pd.Series(np.exp2(-(total / (len(feature) * BILLION)) / typical))

        return forest_score(*filled)

    def _scored(self, df: DataFrame) -> DataFrame:
        """``df`` with ``_score``; natively the trees are conditions over columns of their own, see ``tree_tables``."""
        if not self.native:
            return df.withColumn("_score", self.score())
        filled = [self._filled(name) for name in self.features]
        # Whole billionths below 2 ** 53: the sum is exact in any order.
        summed = with_ensemble_sum(df, "_depths", self.tree_table(df.sparkSession), filled)
        return summed.withColumn("_score", self._strangeness(F.col("_depths"))).drop("_depths")

    def _typical(self) -> float:
        return max(expected_depth(self._sampled), 1e-9)

    def _strangeness(self, depths: Column) -> Column:
        """The score of a row from the depths of its leaves, added up in billionths."""
        return F.pow(F.lit(2.0), -(depths / float(len(self._nodes[0]) * BILLION)) / self._typical())

    def _check_fitted(self) -> None:
        if self.threshold is None:
            raise RuntimeError("The forest has not been grown yet: fit it on training rows before scoring.")


def summarise(scored: DataFrame) -> DataFrame:
    """Flags and mean score per placement and device of scored rows."""
    by = ["placement_type", "device_type"]
    return (
        scored.dropna(subset=by)
        .groupBy(*by)
        .agg(
            F.count("auction_id").alias("total"),
            F.sum(F.col("is_anomaly").cast("int")).alias("anomalies"),
            round_mean(F.avg(F.col("is_anomaly").cast("int")), 4).alias("anomaly_rate"),
            round_mean(F.avg("anomaly_score"), 4).alias("avg_anomaly_score"),
        )
        .orderBy(F.desc("anomaly_rate"), *by)
    )


def top_anomalies(scored: DataFrame, k: int = 20) -> DataFrame:
    return (
        scored.where("is_anomaly")
        .select(
            "auction_id",
            "placement_type",
            "device_type",
            "winning_bid_usd",
            "ecpm",
            "bid_spread",
            "anomaly_score",
        )
        .orderBy(F.desc("anomaly_score"), "auction_id")
        .limit(k)
    )


def either_detector(forest_scored: DataFrame, bid_scored: DataFrame) -> DataFrame:
    """Auctions flagged by the forest, the bid monitor or both."""
    flagged = forest_scored.where("is_anomaly").select("auction_id", F.lit("forest").alias("detector"))
    flagged = flagged.unionByName(
        bid_scored.where("bid_is_anomaly").select("auction_id", F.lit("bid_monitor").alias("detector"))
    )
    return flagged.groupBy("auction_id").agg(
        F.max(F.col("detector") == "forest").alias("by_forest"),
        F.max(F.col("detector") == "bid_monitor").alias("by_bid_monitor"),
    )


def flag_rate(scored: DataFrame) -> DataFrame:
    marked = F.sum(F.col("is_anomaly").cast("int"))
    return scored.agg(
        F.count(F.lit(1)).alias("n_auctions"),
        marked.alias("n_anomalies"),
        F.round(ratio(marked, F.count(F.lit(1))), 4).alias("anomaly_rate"),
    )
