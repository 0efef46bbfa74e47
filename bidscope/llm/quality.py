"""Quality by co-training: a classifier of the text and one of the page's metadata teach each other.

Both views are logistic models over a narrow staged table of features. Each round scores every unlabelled document
with both and moves, per class, the documents that one view is surest of into the training rows of the
other. The rounds end with both views calibrated on labelled rows that neither learnt from, and a logistic
combination of the calibrated views scores all documents. Training rows are bounded (``TRAIN_ROWS`` labelled and
``MOVED`` x ``ROUNDS`` pseudo-labelled per view); features and scores cover every row.
"""

from __future__ import annotations

import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from bidscope.llm.common import bounded_sample, crc_of_id, table
from bidscope.session import stage_table

#: Labelled rows that are learnt from or calibrated on, at most; a quarter of them calibrates.
TRAIN_ROWS = 6_000
ROUNDS = 3
#: Documents a view passes on in a round, shared out by the classes' sizes.
MOVED = 200
_MARKS = "#%&$*!|.,;:?-_=/@(){}[]<>\"'+~^\\"
_BUCKETS = 24
_META = 2 * _BUCKETS + 4


def text_features(text: str | None) -> list[float]:
    """Shapes of a text that do not depend on its language."""
    text = text or ""
    words, lines, n = text.split(), text.split("\n"), max(len(text), 1)
    lowered = [w.lower() for w in words]
    count, m = Counter(lowered), max(len(words), 1)
    pairs = Counter(zip(lowered, lowered[1:]))
    alpha = sum(map(str.isalpha, text))
    ends = Counter(w[-1] for w in words)
    shares = [text.count(c) / n for c in _MARKS]
    return [
        np.log1p(len(words)),
        np.log1p(len(lines)),
        sum(map(len, words)) / m / 10,
        alpha / n,
        sum(map(str.isupper, text)) / n,
        sum(map(str.isdigit, text)) / n,
        len(count) / m,
        max(count.values(), default=0) / m,
        sum(v for v in pairs.values() if v > 1) / m,
        len(set(lines)) / len(lines),
        sum(not c.isalnum() for c in ends.elements()) / m,
        sum(w.isupper() for w in words) / m,
        sum(line.rstrip().endswith((".", "!", "?")) for line in lines) / len(lines),
        *shares,
        *[np.sqrt(s) for s in shares[:10]],
    ]


def meta_features(lang: str | None, source: str | None, n_chars: float | None) -> list[float]:
    """Hashed language and source, and the length that the page's record states."""
    out = [0.0] * _META
    for place, value in enumerate((lang, source)):
        if isinstance(value, str):
            out[place * _BUCKETS + zlib.crc32(value.encode()) % _BUCKETS] = 1.0
    known = n_chars is not None and not np.isnan(n_chars)
    length = np.log1p(max(n_chars, 0.0)) if known else 0.0
    out[-4:] = [length, length**2 / 10, float(not known), float(lang is None)]
    return out


@F.pandas_udf(ArrayType(DoubleType()))
def _text_view(texts: pd.Series) -> pd.Series:
    return pd.Series([text_features(t) for t in texts])


@F.pandas_udf(ArrayType(DoubleType()))
def _meta_view(lang: pd.Series, source: pd.Series, n_chars: pd.Series) -> pd.Series:
    return pd.Series([meta_features(*row) for row in zip(lang, source, n_chars)])


@dataclass
class Logistic:
    """A logistic model over standardised features."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    @staticmethod
    def fit(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> Logistic:
        mean, scale = x.mean(axis=0), x.std(axis=0)
        scale = np.where(scale > 1e-9, scale, 1.0)
        z = np.c_[np.ones(len(x)), np.clip((x - mean) / scale, -8, 8)]
        penalty = ridge * np.eye(z.shape[1])
        penalty[0, 0] = 1e-3
        w = np.zeros(z.shape[1])
        for _ in range(25):
            p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
            step = np.linalg.solve(z.T @ (z * (p * (1 - p))[:, None]) + penalty, z.T @ (p - y) + penalty @ w)
            w -= step
            if np.abs(step).max() < 1e-6:
                break
        return Logistic(mean, scale, w)

    def odds(self, x: np.ndarray) -> np.ndarray:
        return np.c_[np.ones(len(x)), np.clip((x - self.mean) / self.scale, -8, 8)] @ self.weights


@dataclass
class CoTrained:
    """Two views, their calibrations and the combination."""

    text: Logistic
    meta: Logistic
    calibrations: tuple[Logistic, Logistic]
    both: Logistic

    def views(self, text: np.ndarray, meta: np.ndarray) -> np.ndarray:
        own = (self.text.odds(text), self.meta.odds(meta))
        return np.stack([c.odds(o[:, None]) for c, o in zip(self.calibrations, own)], axis=1)


def _matrix(column: pd.Series | list) -> np.ndarray:
    return np.array([np.asarray(v, dtype=float) for v in column])


def features(docs: DataFrame, labels: DataFrame, learn: Column | None = None) -> DataFrame:
    """``doc_id, text_view, meta_view, label``, staged; the label is null where there is none to learn from.

    ``docs`` needs ``doc_id`` and ``text``; ``lang``, ``source`` and ``n_chars`` may be absent or null. Of several
    labels for an id the largest counts. A null id has no label.
    """
    def column(name: str, kind: str) -> Column:
        return F.col(name).cast(kind) if name in docs.columns else F.lit(None).cast(kind)

    views = docs.select(
        "doc_id",
        _text_view("text").alias("text_view"),
        _meta_view(column("lang", "string"), column("source", "string"), column("n_chars", "double")).alias("meta_view"),
    )
    marks = labels.where("quality IS NOT NULL").where(learn if learn is not None else F.lit(True))
    marks = marks.groupBy(F.col("doc_id").alias("id")).agg((F.max("quality") > 0).cast("int").alias("label"))
    staged = stage_table(views, "quality_views")
    return staged.join(marks, F.col("doc_id") == F.col("id"), "left").drop("id")


def co_train(rows: DataFrame, rounds: int = ROUNDS, moved: int = MOVED, train_rows: int = TRAIN_ROWS) -> CoTrained | None:
    """Learn from ``features``; None where the labelled rows do not hold both classes."""
    rows = stage_table(rows, "quality_rows")
    known = bounded_sample(rows.where("label IS NOT NULL"), F.col("doc_id"), train_rows).collect()  # ``train_rows`` at most
    known.sort(key=lambda r: r["doc_id"])
    calibrates = np.array([zlib.crc32(f"calibrate {r['doc_id']}".encode()) % 4 == 0 for r in known], dtype=bool)
    y = np.array([r["label"] for r in known], dtype=float)
    if any(len(set(y[part])) < 2 for part in (calibrates, ~calibrates)):
        return None
    views = {name: _matrix([r[name] for r in known]) for name in ("text_view", "meta_view")}
    x = {name: v[~calibrates] for name, v in views.items()}
    target = {name: y[~calibrates] for name in views}
    share, used, open_rows = y.mean(), set(), rows.where("label IS NULL AND doc_id IS NOT NULL")
    models = {name: Logistic.fit(x[name], target[name]) for name in views}
    for _ in range(rounds):
        scored = open_rows.select("*", _odds(models["text_view"])("text_view").alias("t"), _odds(models["meta_view"])("meta_view").alias("m"))
        scored = stage_table(scored.select("doc_id", "t", "m"), "quality_odds")
        for teacher, pupil in (("t", "meta_view"), ("m", "text_view")):
            chosen: dict[int, float] = {}
            for label, order, n in ((1.0, F.desc(teacher), round(moved * share)), (0.0, F.asc(teacher), round(moved * (1 - share)))):
                free = scored.where(~F.col("doc_id").isin(sorted(used))) if used else scored
                for row in free.orderBy(order, F.xxhash64("doc_id"), "doc_id").limit(max(n, 1)).collect():
                    chosen[row["doc_id"]] = label
                    used.add(row["doc_id"])
            taught = open_rows.where(F.col("doc_id").isin(sorted(chosen))).select("doc_id", pupil) if chosen else None
            got = sorted(taught.collect(), key=lambda r: (r[0], r[1])) if taught is not None else []
            if got:
                x[pupil] = np.concatenate([x[pupil], _matrix([r[1] for r in got])])
                target[pupil] = np.concatenate([target[pupil], [chosen[r[0]] for r in got]])
        models = {name: Logistic.fit(x[name], target[name]) for name in views}
    own = [models[name].odds(views[name][calibrates])[:, None] for name in ("text_view", "meta_view")]
    calibrations = tuple(Logistic.fit(o, y[calibrates], 0.1) for o in own)
    calibrated = np.concatenate([c.odds(o)[:, None] for c, o in zip(calibrations, own)], axis=1)
    both = Logistic.fit(calibrated, y[calibrates], 0.1)
    return CoTrained(models["text_view"], models["meta_view"], calibrations, both)


def _odds(model: Logistic):  # noqa: ANN202
    @F.pandas_udf(DoubleType())
    def odds(view: pd.Series) -> pd.Series:
        return pd.Series(model.odds(_matrix(view)) if len(view) else [], dtype="float64")

    return odds


def score(rows: DataFrame, model: CoTrained | None) -> DataFrame:
    """``doc_id, text_score, meta_score, score, predicted`` of every row of ``features``.

    All scores are 0.5 where there was nothing to learn from. Texts that are null or empty are scored like any
    other; repeated rows and null ids stay; an empty table gives no rows.
    """

    @F.pandas_udf("text_score double, meta_score double, score double")
    def combined(text: pd.Series, meta: pd.Series) -> pd.DataFrame:
        names = ["text_score", "meta_score", "score"]
        if model is None or not len(text):
            return pd.DataFrame(0.5, index=range(len(text)), columns=names)
        views = model.views(_matrix(text), _matrix(meta))
        odds = np.c_[views, model.both.odds(views)]
        return pd.DataFrame(1 / (1 + np.exp(-np.clip(odds, -30, 30))), columns=names)

    found = rows.select("doc_id", combined("text_view", "meta_view").alias("s"))
    return found.select("doc_id", "s.*").withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def held_out() -> Column:
    return F.coalesce(F.pmod(crc_of_id("doc_id"), F.lit(5)) == 0, F.lit(False))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = features(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ~held_out())
    return score(rows, co_train(rows)).withColumn("held_out", held_out())
