"""Toxicity by subword-bag embeddings averaged into a linear softmax.

A word is the average of the embeddings of its character n-grams, so a misspelling or an inflection that was
never seen still shares most of its vectors with the words that were. A text is cut into passages of
``PASSAGE`` words; a passage is the average of its words, and a linear softmax over that average
gives its class. The passage likeliest to be toxic decides the text. Embeddings and softmax are learnt jointly, in numpy,
by full-batch descent with momentum on a bounded sample of labelled texts.
"""

from __future__ import annotations

from array import array
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from bidscope.llm.common import bounded_sample, crc_of_id, table
from bidscope.session import stage_table

#: Labelled texts the model is fitted on, at most.
TRAIN_ROWS = 2_000
PASSAGE = 8
BITS = 17
BUCKETS = 1 << BITS
DIMENSIONS = 4
NGRAMS = (3, 6)
ROUNDS = 80
RATE = 0.05
#: Texts an n-gram must occur in to be learnt.
MIN_TEXTS = 5
SEED = 11
#: Multiplies the average, so that one word in a passage can outweigh the others.
SCALE = 8.0
#: The odds against label 1 that learning starts from.
START = 6.0


_ALNUM: dict[str, np.ndarray] = {}


def _codes(text: str) -> np.ndarray:
    """Lower-case letters and digits as code points, each run of anything else, and both ends, as one 0."""
    if not _ALNUM:
        _ALNUM["is"] = np.fromiter((chr(i).isalnum() for i in range(0x110000)), dtype=bool, count=0x110000)
    raw = np.frombuffer(text.lower().encode("utf-32-le", "replace"), dtype=np.uint32)
    codes = np.zeros(len(raw) + 2, dtype=np.uint64)
    codes[1:-1] = np.where(_ALNUM["is"][raw], raw, 0)
    keep = np.ones(len(codes), dtype=bool)
    keep[1:] = (codes[1:] != 0) | (codes[:-1] != 0)
    return codes[keep]


def _grams(codes: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each length, the start and the bucket of every n-gram that stays in one word with its end marks."""
    ends = np.cumsum(codes == 0)
    rolled, out = np.zeros(len(codes), dtype=np.uint64), []
    for n in range(1, NGRAMS[1] + 1):
        rolled = rolled[: len(codes) - n + 1] * np.uint64(1_000_003) + codes[n - 1 :] + np.uint64(1)
        if n >= NGRAMS[0]:
            inside = ends[n - 2 : len(codes) - 1] - ends[: len(rolled)]
            start = np.flatnonzero(inside == 0)
            mixed = rolled[start] * np.uint64(0x9E3779B97F4A7C15)
            out.append((start, (mixed >> np.uint64(64 - BITS)).astype(np.int64)))
    return out


def word_scores(text: str | None, weights: np.ndarray) -> np.ndarray:
    """The mean weight of the n-grams of each word of a text, in order."""
    codes = _codes(text or "")
    if len(codes) < 3:
        return np.empty(0)
    total, count = np.zeros(len(codes)), np.zeros(len(codes))
    for start, bucket in _grams(codes):
        weight = weights[bucket]
        known = ~np.isnan(weight)  # an n-gram that was not learnt is no part of its word's mean
        total[start[known]] += weight[known]
        count[start[known]] += 1
    opens = np.flatnonzero(codes == 0)[:-1]
    return np.add.reduceat(total, opens) / np.maximum(np.add.reduceat(count, opens), 1)


def subwords(words: list[str], chunk: int = 20_000) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of the words' character n-grams, word by word, and where each word's begin."""
    parts, sizes = [], [np.zeros(1, dtype=np.int64)]
    for first in range(0, len(words), chunk):
        own = words[first : first + chunk]
        codes = _codes(" ".join(own))
        number = (np.cumsum(codes == 0) - 1).astype(np.int32)
        grams = _grams(codes)
        word = np.concatenate([number[start] for start, _ in grams])
        buckets = np.concatenate([bucket.astype(np.int32) for _, bucket in grams])
        parts.append(buckets[np.argsort(word, kind="stable")])
        sizes.append(np.bincount(word, minlength=len(own)))
    return np.concatenate(parts), np.cumsum(np.concatenate(sizes))


def words_of(text: str | None) -> list[str]:
    codes = _codes(text or "")
    return "".join(map(chr, np.where(codes == 0, 32, codes).tolist())).split()


@dataclass
class Model:
    """What scoring needs: per bucket the embedding times the softmax's difference of classes, and the bias."""

    weights: np.ndarray
    bias: float

    def score(self, text: str | None) -> float:
        """The likelihood of label 1 by the likeliest passage; a text without words is one empty passage."""
        words = word_scores(text, self.weights)
        odds = self.bias
        if len(words):
            opens = np.arange(0, len(words), PASSAGE)
            sizes = np.diff(np.r_[opens, len(words)])
            odds += float((np.add.reduceat(words, opens) / sizes).max())
        return float(1 / (1 + np.exp(-np.clip(odds, -500, 500))))


def _sums(values: np.ndarray, members: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums of the members' rows from each start to the next, a column at a time."""
    return np.stack([np.add.reduceat(column[members], starts) for column in np.ascontiguousarray(values.T)], axis=1)


def fit(texts: list[str | None], labels: list[int], prior: float | None = None) -> Model:
    """Learn from whole texts and their 0/1 labels; ``prior`` is the share of 1 to expect, if not that of the labels.

    Texts without words teach nothing. With one class only, or none, every score is near that class.
    """
    pairs = [(t, y) for t, y in zip(texts, labels) if len(_codes(t or "")) > 1]
    texts, labels = [t for t, _ in pairs], [y for _, y in pairs]
    rng = np.random.default_rng(SEED)
    target = np.asarray(labels, dtype=np.float64)
    share = float(target.mean()) if len(target) else 0.0
    if share in (0.0, 1.0):
        return Model(np.zeros(BUCKETS), 20.0 * (2 * share - 1))
    number: dict[str, int] = {}
    tokens, lengths = array("i"), []
    for text in texts:
        words = words_of(text)
        tokens.extend(number.setdefault(w, len(number)) for w in words)
        lengths.append(len(words))
    in_bag, length = np.frombuffer(tokens, dtype=np.int32), np.array(lengths)
    text_at = np.r_[0, np.cumsum(length)]
    bags = -(-length // PASSAGE)
    owner = np.repeat(np.arange(len(texts)), bags)
    opens = np.r_[0, np.cumsum(bags)[:-1]]
    bag_at = text_at[owner] + PASSAGE * (np.arange(len(owner)) - opens[owner])
    bag_size = np.diff(np.r_[bag_at, len(in_bag)])
    bag_of = np.repeat(np.arange(len(bag_at), dtype=np.int32), bag_size)
    in_word, word_at, odds_of = _frequent(*subwords(list(number)), in_bag, text_at, target)
    del number
    word_size = np.diff(word_at)
    word_at, word_of = word_at[:-1], np.repeat(np.arange(len(word_size), dtype=np.int32), word_size)

    embed = rng.normal(0, 0.05, (BUCKETS, DIMENSIONS)).astype(np.float32)
    embed[:, 0] = odds_of
    soft = rng.normal(0, 0.05, (DIMENSIONS, 2)).astype(np.float32)
    soft[0] = -0.5, 0.5
    bias = np.array([START / 2, -START / 2], dtype=np.float32)
    state = [np.zeros_like(p) for p in (embed, soft, bias)]
    for step in range(1, ROUNDS + 1):
        words = _sums(embed, in_word, word_at) / word_size[:, None]
        means = SCALE * _sums(words, in_bag, bag_at) / bag_size[:, None]
        logits = means @ soft + bias
        odds = logits[:, 1] - logits[:, 0]
        # The softest maximum over a text's passages: each counts by its share of exp(odds).
        top = np.maximum.reduceat(odds, opens)
        weight = np.exp(odds - top[owner])
        weight /= np.add.reduceat(weight, opens)[owner]
        text_odds = np.add.reduceat(weight * odds, opens)
        error = 1 / (1 + np.exp(-text_odds)) - target
        slope = (error[owner] * weight / len(target)).astype(np.float32)
        d_logits = np.stack([-slope, slope], axis=1)
        d_soft, d_bias = means.T @ d_logits, d_logits.sum(axis=0)
        d_means = (d_logits @ soft.T) * (SCALE / bag_size[:, None])
        d_words = _transposed(d_means, bag_of, in_bag, len(word_size)) / word_size[:, None]
        d_embed = _transposed(d_words, word_of, in_word, BUCKETS)
        # One step length for a whole table: the n-grams that many texts agree on move, rare ones hardly do.
        rate = RATE * (1 - (step - 1) / ROUNDS)
        for p, g, m in zip((embed, soft, bias), (d_embed, d_soft, d_bias), state):
            m += 0.3 * (g - m)
            p -= rate * m / (np.abs(m).max() + 1e-12)
    shift = _log_odds(share if prior is None else prior) - _log_odds(share)
    known = np.zeros(BUCKETS, dtype=bool)
    known[in_word] = True
    weights = np.where(known, SCALE * embed @ (soft[:, 1] - soft[:, 0]), np.nan)
    weights[0] = np.nan
    return Model(weights.astype(np.float64), float(bias[1] - bias[0] + shift))


def _log_odds(share: float) -> float:
    return float(np.log(share / (1 - share)))


def _frequent(
    pieces: np.ndarray, at: np.ndarray, tokens: np.ndarray, text_at: np.ndarray, target: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The pieces of each word that occur in ``MIN_TEXTS`` texts or more (bucket 0 alone where there are none), where
    each word's begin, and the log odds of each bucket by the texts it occurs in: where learning starts."""
    seen = np.zeros((2, BUCKETS))
    for label, start, stop in zip(target.astype(int), text_at, text_at[1:]):
        own = [pieces[at[w] : at[w + 1]] for w in np.unique(tokens[start:stop])]
        seen[label, np.unique(np.concatenate(own))] += 1
    known = seen.sum(axis=0) >= MIN_TEXTS
    known[0] = False
    odds = np.log((seen[1] + 2) / (target.sum() + 4)) - np.log((seen[0] + 2) / ((1 - target).sum() + 4))
    keep = known[pieces]
    size = np.add.reduceat(keep, at[:-1], dtype=np.int64)
    keep[at[:-1][size == 0]] = True
    kept = np.where(known[pieces], pieces, 0)[keep]
    return kept, np.r_[0, np.cumsum(np.maximum(size, 1))], np.where(known, odds, 0.0)


def _transposed(values: np.ndarray, rows: np.ndarray, cols: np.ndarray, size: int) -> np.ndarray:
    """Each column's sum of the rows it stands in."""
    return np.stack(
        [np.bincount(cols, values[rows, k], minlength=size) for k in range(values.shape[1])], axis=1
    ).astype(np.float32)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, score`` of every row: the likelihood of label 1 by the likeliest passage.

    A null or empty text, or one without words, has the score of an empty passage. Repeated rows and null ids
    stay. Other columns are not read.
    """
    return docs.select(F.col(id_col).alias("doc_id"), scorer(model)(F.col(text_col)).alias("score"))


def scorer(model: Model):  # noqa: ANN201
    """A column function from text to score."""
    @F.pandas_udf(DoubleType())
    def likelihood(texts: pd.Series) -> pd.Series:
        return pd.Series([model.score(text) for text in texts], dtype="float64")

    return likelihood


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Model:
    """A model from at most ``rows`` labelled documents, about half of them toxic where there are as many.

    The sample is drawn from the labels, by a hash of the id, before any text is read; the share of toxic labels
    among all of them is the prior. Null ids, null labels and labels without a document teach nothing.
    """
    marks = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").select(
        F.col("doc_id").alias("id"), (F.col("toxic") > 0).cast("int").alias("mark")
    )
    shares = marks.agg(F.count(F.lit(1)), F.sum("mark")).first()
    drawn = [bounded_sample(marks.where(f"mark = {m}"), F.col("id"), rows // 2) for m in (0, 1)]
    sample = stage_table(drawn[0].union(drawn[1]), "toxicity_sample")
    texts = docs.select("doc_id", "text").join(sample, F.col("doc_id") == F.col("id"))
    got = sorted(((r["doc_id"], r["text"] or "", r["mark"]) for r in texts.collect()))  # ``rows`` at most
    prior = shares[1] / shares[0] if shares[0] and 0 < shares[1] < shares[0] else None
    return fit([g[1] for g in got], [g[2] for g in got], prior)


def held_out() -> Column:
    return F.coalesce(F.pmod(crc_of_id("doc_id"), F.lit(5)) == 0, F.lit(False))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(docs, table(spark, sf_dir, "labels").where(~held_out()))
    scored = docs.select("doc_id", held_out().alias("held_out"), scorer(model)(F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
