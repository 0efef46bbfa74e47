"""Mixing to target weights with soft membership.

DataFrame functions only. A naive Bayes classifier over hashed words, counted on labelled rows, gives each
document the probabilities of the domains. The rates are the nonnegative least-squares fit of the expected domain
tokens to the targets: projected gradient, in which the error of the domain totals, one number per domain, is all that
travels. A step moves a rate against the error weighted by the document's probabilities and cuts it at zero. The error is
measured in the inverse of the domains' token covariance, which makes a step of length one safe and quick.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bidscope.llm.common import bounded_sample, table
from bidscope.session import stage_table

#: Labelled rows that the classifier counts, at most.
TRAIN_ROWS = 10_000
BUCKETS = 4096
STEPS = 60
#: Largest error of a domain's tokens, as a share of all tokens, at which the steps end.
TOLERANCE = 1e-6


def _words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"\s+"), "")


def _doubles(values: list[float]) -> Column:
    """A constant array, parsed once when the plan is made."""
    return F.split(F.lit(",".join(map(repr, map(float, values)))), ",").cast("array<double>")


def classifier(labelled: DataFrame, domain_col: str, text_col: str = "text") -> dict[str, list[float]]:
    """Per domain, sorted, the log odds of each word bucket against all domains, and last the log prior."""
    words = labelled.where(F.col(domain_col).isNotNull()).select(
        F.col(domain_col).alias("domain"), F.explode(_words(F.col(text_col))).alias("word")
    )
    bucket = F.pmod(F.xxhash64("word"), F.lit(BUCKETS)).cast("int").alias("bucket")
    cells = words.groupBy("domain", bucket).agg(F.count(F.lit(1)).alias("n")).collect()  # domains x BUCKETS at most
    names = sorted({r["domain"] for r in cells})
    if not names:
        return {}
    counts = np.ones((len(names), BUCKETS))
    for r in cells:
        counts[names.index(r["domain"]), r["bucket"]] += r["n"]
    odds = np.log(counts / counts.sum(axis=1, keepdims=True)) - np.log(counts.sum(axis=0) / counts.sum())
    prior = np.log(counts.sum(axis=1) / counts.sum())
    return {name: [*odds[k].tolist(), float(prior[k])] for k, name in enumerate(names)}


def with_posteriors(docs: DataFrame, model: dict[str, list[float]], text_col: str = "text") -> DataFrame:
    """``row`` (all columns as a struct), ``tokens`` and ``p``: the probabilities of the model's domains, in its order.

    The evidence of a text's words is divided by the root of their number, so that memberships stay soft. A text
    without words has the priors.
    """
    places = docs.select(F.struct("*").alias("row"), _words(F.col(text_col)).alias("w")).select(
        "row", F.transform("w", lambda w: F.pmod(F.xxhash64(w), F.lit(BUCKETS)).cast("int")).alias("h")
    )
    evidence = []
    for numbers in model.values():
        weights = _doubles(numbers[:-1])
        total = F.aggregate("h", F.lit(0.0), lambda acc, h: acc + F.get(weights, h))  # noqa: B023
        evidence.append(F.lit(numbers[-1]) + total / F.sqrt(F.greatest(F.size("h"), F.lit(1)).cast("double")))
    scored = places.select("row", F.size("h").cast("long").alias("tokens"), F.array(*evidence).alias("e"))
    grown = scored.select("row", "tokens", F.transform("e", lambda v: F.exp(v - F.array_max("e"))).alias("g"))
    total = F.aggregate("g", F.lit(0.0), lambda acc, v: acc + v)
    return grown.select("row", "tokens", F.transform("g", lambda v: v / total).alias("p"))


def _rate(moves: list[np.ndarray]) -> Column:
    """The rate after all steps so far, from the probabilities alone."""
    rate = F.lit(1.0)
    if not moves:
        return rate
    steps = F.array(*[_doubles(m.tolist()) for m in moves])
    return F.aggregate(
        steps,
        rate,
        lambda r, step: F.greatest(
            F.lit(0.0), r - F.aggregate(F.zip_with("p", step, lambda a, b: a * b), F.lit(0.0), lambda x, y: x + y)
        ),
    )


def fit_rates(rows: DataFrame, targets: list[float], steps: int = STEPS) -> tuple[list[np.ndarray], np.ndarray]:
    """The moves that lead to the rates, and the expected tokens per domain they give.

    ``rows`` has ``tokens, p``; ``targets`` are shares of the present number of tokens. Each step is one aggregate of as many
    numbers as there are domains.
    """
    k = len(targets)
    cells = rows.agg(
        F.sum("tokens"),
        *[F.sum(F.col("tokens") * F.get("p", F.lit(i)) * F.get("p", F.lit(j))) for i in range(k) for j in range(i + 1)],
    ).first()
    total = float(cells[0] or 0)
    if not total:
        return [], np.zeros(k)
    gram = np.zeros((k, k))
    gram[np.tril_indices(k)] = cells[1:]
    gram = gram + np.tril(gram, -1).T
    metric = np.linalg.inv(gram + 1e-9 * np.trace(gram) * np.eye(k))
    wanted, moves = np.array(targets) * total, []
    while True:
        rate = _rate(moves)
        sums = rows.select(*[(F.col("tokens") * rate * F.get("p", F.lit(i))).alias(f"d{i}") for i in range(k)])
        got = np.array(sums.agg(*[F.sum(f"d{i}") for i in range(k)]).first(), dtype=float)
        if np.abs(got - wanted).max() <= TOLERANCE * total or len(moves) == steps:
            return moves, got
        moves.append(metric @ (got - wanted))


def mix(
    docs: DataFrame,
    labelled: DataFrame,
    domain_col: str = "lang",
    weights: dict[str, float] | None = None,
    columns: list[str] | None = None,
    text_col: str = "text",
    id_col: str = "doc_id",
) -> DataFrame:
    """The ``columns`` of ``docs`` (all by default) and ``n_tokens, mix_domain, mix_posterior, mix_rate, mix_copies, mix_error``.

    ``weights`` are the target shares by domain, scaled to sum to one; by default all domains are wanted alike, and a
    domain without labelled rows cannot be served and is an error. The rate says how often a document is to be seen;
    the copies are the rate rounded up or down by a hash of the id, which keeps the expectation. Without labelled rows,
    and without tokens, every rate is 1. Every row comes back; null texts have no tokens and the rate of the
    priors. ``mix_error`` is what no rates could mend, or ``STEPS`` steps did not: the greatest difference of a domain's
    expected share from its target, the same in every row. A column of ``docs`` with a new one's name gets ``_in`` behind it.
    """
    model = classifier(bounded_sample(labelled, F.col(id_col), TRAIN_ROWS), domain_col, text_col)
    wanted = {name: 1.0 for name in model} if weights is None else weights
    if unknown := sorted(set(wanted) - set(model)):
        if model:
            raise ValueError(f"no labelled rows of {', '.join(unknown)}")
    shares = [wanted.get(name, 0.0) / (sum(wanted.values()) or 1.0) for name in model]
    kept = columns or docs.columns
    scored = with_posteriors(docs, model, text_col) if model else docs.select(
        F.struct("*").alias("row"), F.size(_words(F.col(text_col))).cast("long").alias("tokens"), F.array().cast("array<double>").alias("p")
    )
    narrow = scored.select(F.struct(*[F.col("row")[c].alias(c) for c in {*kept, id_col}]).alias("row"), "tokens", "p")
    rows = stage_table(narrow, "posteriors")
    moves, got = fit_rates(rows, shares) if model else ([], np.zeros(0))
    total = float(rows.agg(F.sum("tokens")).first()[0] or 0)
    error = float(np.abs(got / total - shares).max()) if model and total else 0.0
    names = F.array(*map(F.lit, model)) if model else F.array().cast("array<string>")
    share = F.pmod(F.xxhash64(F.lit("copies"), F.col("row")[id_col]), F.lit(1_000_000)) / 1e6
    new = {"n_tokens", "mix_domain", "mix_posterior", "mix_rate", "mix_copies", "mix_error"}
    rated = rows.withColumn("rate", _rate(moves)).select(
        *[F.col("row")[c].alias(f"{c}_in" if c.lower() in new else c) for c in kept],
        F.col("tokens").alias("n_tokens"),
        F.get(names, F.array_position("p", F.array_max("p")).cast("int") - 1).alias("mix_domain"),
        F.col("p").alias("mix_posterior"),
        F.col("rate").alias("mix_rate"),
        (F.floor("rate") + (share < F.col("rate") - F.floor("rate")).cast("long")).alias("mix_copies"),
        F.lit(error).alias("mix_error"),
    )
    return rated


def sampled(mixed: DataFrame) -> DataFrame:
    """The mix itself: every row of ``mixed`` ``mix_copies`` times, numbered from 1 in ``mix_copy``; none where there are none."""
    numbers = F.when(F.col("mix_copies") > 0, F.sequence(F.lit(1).cast("long"), "mix_copies"))
    return mixed.select("*", F.explode(numbers).alias("mix_copy"))


def op6_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return mix(docs, docs.where("lang IS NOT NULL"), "lang", columns=["doc_id"])
