"""Language-model scores from a lattice of subword pieces.

A word is spelled by pieces of an existing vocabulary, and its probability is the sum over all its segmentations,
taken by a forward recursion in log space. The vocabulary's own scores weight the pieces to begin with; rounds of
expectation-maximisation over the distinct words of the training texts refine these weights (the pieces stay as
they are). A word that was seen in training also has an arc of its own over the whole word, weighted by its
discounted frequency; the mass that the discount sets aside goes to the pieces. What a text is worth is the sum over
all paths through its words, and the end.

Words are counted once over the corpus, and everything else is done per distinct word. A text looks up the most
frequent words, a bounded table, where it is read; its other words join the full table.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bidscope.llm.common import crc_of_id, table
from bidscope.session import spread, stage_table

#: The default vocabulary file; a parameter of ``op11_lattice_lm``.
VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
#: Taken from the count of each distinct training word, and left to the pieces.
DISCOUNT = 0.75
#: Rounds of expectation-maximisation, and how many occurrences the first weights count for in each.
ROUNDS = 2
PRIOR = 100.0
#: Most frequent words that every task holds, at most, and their bytes, at most.
FREQUENT = 1 << 18
FREQUENT_BYTES = 32 << 20
#: Distinct words and bytes of words that a task counts before it hands them on.
HELD = 400_000
HELD_BYTES = 64 << 20

_START, _PAD = 257, 256
#: Cells (words x places x longest piece) of one step of the recursions, at most.
_CELLS = 1 << 19
_LOG10 = float(np.log(10.0))
_END = b""


@dataclass(frozen=True)
class Pieces:
    """Pieces as code sequences (bytes, 257 for the start of a word) and their log weights, which sum to one."""

    codes: tuple[tuple[int, ...], ...]
    logs: np.ndarray

    @cached_property
    def trie(self) -> tuple[np.ndarray, np.ndarray]:
        """Next node by node and code (0: none, 1: root), and the piece that ends at a node (-1: none)."""
        children: list[dict[int, int]] = [{}, {}]
        ends = {}
        for number, codes in enumerate(self.codes):
            node = 1
            for code in codes:
                following = children[node].get(code)
                if following is None:
                    following = children[node][code] = len(children)
                    children.append({})
                node = following
            ends[node] = number
        step = np.zeros((len(children), 258), dtype=np.int32)
        for node, following in enumerate(children):
            for code, child in following.items():
                step[node, code] = child
        piece = np.full(len(children), -1, dtype=np.int32)
        piece[list(ends)] = list(ends.values())
        return step, piece

    @cached_property
    def longest(self) -> int:
        return max(map(len, self.codes))

    def weighted(self, logs: np.ndarray) -> Pieces:
        """The same pieces with other weights; the trie is shared."""
        other = Pieces(self.codes, logs)
        other.__dict__["trie"] = self.trie
        return other


def pieces_of(scored: Sequence[tuple[str, float]], ranked: bool) -> Pieces:
    """Pieces with a leading U+2581 for the start of a word, and one for each byte and for the start itself.

    Scores are log probabilities, or, where ``ranked``, minus the place in a list by falling frequency; places turn
    into weights by Zipf's law.
    """
    best: dict[tuple[int, ...], float] = {}
    for text, score in scored:
        starts, rest = text.startswith("▁"), text.removeprefix("▁")
        if "▁" in rest:
            continue
        codes = (_START,) * starts + tuple(rest.encode())
        log = -float(np.log1p(max(-score, 0.0))) if ranked else score
        best[codes] = max(log, best.get(codes, -np.inf))
    least = min(best.values(), default=0.0)
    for code in [*range(256), _START]:
        best.setdefault((code,), least)
    best.pop((), None)
    ordered = sorted(best)
    logs = np.array([best[c] for c in ordered])
    return Pieces(tuple(ordered), logs - np.logaddexp.reduce(logs))


def read_vocabulary(path: str) -> Pieces:
    """The pieces of a sentencepiece model file; unused, unknown and control entries are left out."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    scored = [
        (model.id_to_piece(i), model.get_score(i))
        for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i) or model.is_byte(i))
    ]
    # Merges are scored by minus their place; log probabilities are not whole numbers.
    ranked = all(float(score).is_integer() for _, score in scored)
    return pieces_of(scored, ranked)


def _coded(words: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Words as rows of codes, each with its start, padded to the longest; and their lengths."""
    lengths = np.fromiter((len(w) + 1 for w in words), dtype=np.int64, count=len(words))
    codes = np.full((len(words), int(lengths.max())), _PAD, dtype=np.int64)
    inside = np.arange(codes.shape[1]) < lengths[:, None]
    flat = np.full(int(lengths.sum()), _START, dtype=np.int64)
    starts = np.cumsum(lengths) - lengths
    rest = np.ones(len(flat), dtype=bool)
    rest[starts] = False
    flat[rest] = np.frombuffer(b"".join(words), dtype=np.uint8)
    codes[inside] = flat
    return codes, lengths


def _arcs(codes: np.ndarray, pieces: Pieces, start: int, stop: int) -> np.ndarray:
    """For each word, place in [start, stop) and length, the piece that spells it there, or -1."""
    step, piece = pieces.trie
    found = np.full((len(codes), stop - start, pieces.longest), -1, dtype=np.int32)
    reach = 1
    row, place = np.divmod(np.arange(len(codes) * (stop - start)), stop - start)
    node = np.ones(len(row), dtype=np.int64)
    for length in range(pieces.longest):
        at = place + start + length
        in_word = at < codes.shape[1]
        if not in_word.all():
            row, place, node, at = row[in_word], place[in_word], node[in_word], at[in_word]
        node = step[node, codes[row, at]]
        alive = node > 0
        row, place, node = row[alive], place[alive], node[alive]
        if not len(row):
            break
        found[row, place, length] = piece[node]
        reach = length + 1
    return found[:, :, :reach]


def _blocks(codes: np.ndarray, pieces: Pieces) -> list[tuple[int, int]]:
    width = max(1, _CELLS // (len(codes) * pieces.longest))
    return [(s, min(s + width, codes.shape[1])) for s in range(0, codes.shape[1], width)]


def _log_weights(found: np.ndarray, pieces: Pieces) -> np.ndarray:
    return np.where(found >= 0, pieces.logs[found], -np.inf)


def _forward(codes: np.ndarray, pieces: Pieces) -> np.ndarray:
    """The log of the summed weights of all ways to spell each word up to each place."""
    alpha = np.full((len(codes), codes.shape[1] + 1 + pieces.longest), -np.inf)
    alpha[:, 0] = 0.0
    for start, stop in _blocks(codes, pieces):
        logs = _log_weights(_arcs(codes, pieces, start, stop), pieces)
        for place in range(start, stop):
            ahead = alpha[:, place + 1 : place + 1 + logs.shape[2]]
            np.logaddexp(ahead, alpha[:, place, None] + logs[:, place - start], out=ahead)
    return alpha


def _by_length(words: Sequence[bytes], longest: int) -> Iterator[np.ndarray]:
    """Places of the words in groups of near lengths, each small enough for one array."""
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    order = np.argsort(lengths, kind="stable")
    start = 0
    while start < len(order):
        # Rows as long as the last one of the group.
        stop = start + 1
        rows = max(1, _CELLS // ((int(lengths[order[start]]) + 1) * longest))
        stop = min(start + rows, len(order))
        while stop > start + 1 and (stop - start) * (int(lengths[order[stop - 1]]) + 1) * longest > 2 * _CELLS:
            stop = start + (stop - start) // 2
        yield order[start:stop]
        start = stop


def spelled(words: Sequence[bytes], pieces: Pieces) -> np.ndarray:
    """The log probability of each word, summed over its segmentations."""
    out = np.zeros(len(words))
    with np.errstate(invalid="ignore"):
        for group in _by_length(words, pieces.longest):
            codes, lengths = _coded([words[i] for i in group])
            out[group] = _forward(codes, pieces)[np.arange(len(group)), lengths]
    return out


def expected(words: Sequence[bytes], pieces: Pieces) -> np.ndarray:
    """How often each piece is expected in the words, each taken once, over their segmentations by weight."""
    counts = np.zeros(len(pieces.codes))
    with np.errstate(invalid="ignore", divide="ignore"):
        for group in _by_length(words, pieces.longest):
            codes, lengths = _coded([words[i] for i in group])
            alpha = _forward(codes, pieces)
            whole = alpha[np.arange(len(group)), lengths]
            beta = np.full_like(alpha, -np.inf)
            beta[np.arange(len(group)), lengths] = 0.0
            for start, stop in reversed(_blocks(codes, pieces)):
                found = _arcs(codes, pieces, start, stop)
                logs = _log_weights(found, pieces)
                for place in range(stop - 1, start - 1, -1):
                    after = logs[:, place - start] + beta[:, place + 1 : place + 1 + logs.shape[2]]
                    top = after.max(axis=1)
                    safe = np.where(np.isfinite(top), top, 0.0)
                    reached = np.log(np.exp(after - safe[:, None]).sum(axis=1)) + safe
                    beta[:, place] = np.where(lengths == place, 0.0, np.where(lengths < place, -np.inf, reached))
                    logs[:, place - start] = after
                share = np.exp(alpha[:, start:stop, None] + logs - whole[:, None, None])
                used = (found >= 0) & (share > 0)
                counts += np.bincount(found[used], weights=share[used], minlength=len(counts))
    return counts


def words_of(text: bytes | None) -> list[bytes]:
    """A-Z in lower case; words are what stands between the six ASCII white-space characters."""
    return text.lower().split() if text else []


def word_counts(docs: DataFrame, text_col: str, trains: Column) -> DataFrame:
    """``word, total, c``: every distinct word, its occurrences, and those in training texts; the end is an empty word."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[Counter, Counter] = (Counter(), Counter())
        size = 0
        for batch in batches:
            for text, training in zip(batch.column("text").to_pylist(), batch.column("trains").to_pylist()):
                words = words_of(text)
                counter = held[bool(training)]
                counter.update(words)
                counter[_END] += 1
                size += len(text or b"")
                if len(held[0]) + len(held[1]) > HELD or size > HELD_BYTES:
                    yield _counted(*held)
                    held, size = (Counter(), Counter()), 0
        yield _counted(*held)

    rows = docs.select(F.col(text_col).cast("binary").alias("text"), trains.alias("trains"))
    parts = spread(rows).mapInArrow(count, "word binary, total long, c long")
    return parts.groupBy("word").agg(F.sum("total").alias("total"), F.sum("c").alias("c"))


def _counted(others: Counter, training: Counter) -> pa.RecordBatch:
    words = list(training.keys() | others.keys())
    c = np.fromiter((training[w] for w in words), dtype=np.int64, count=len(words))
    total = c + np.fromiter((others[w] for w in words), dtype=np.int64, count=len(words))
    return pa.RecordBatch.from_arrays(
        [pa.array(words, pa.binary()), pa.array(total), pa.array(c)], names=["word", "total", "c"]
    )


def fit_pieces(
    words: DataFrame, pieces: Broadcast[Pieces], rounds: int = ROUNDS, prior: float = PRIOR
) -> np.ndarray:
    """Log weights after ``rounds`` of expectation-maximisation over the distinct words (``word``), each counted once.

    A word counts once because the pieces spell what the discount takes, which is the same for every word. Sums of a
    task are rounded to millionths, so that their order does not matter.
    """
    logs = pieces.value.logs
    first = np.exp(logs)
    for _ in range(rounds):

        def expect(batches: Iterator[pa.RecordBatch], logs: np.ndarray = logs) -> Iterator[pa.RecordBatch]:
            total, weighted = None, pieces.value.weighted(logs)
            for batch in batches:
                counts = expected(batch.column("word").to_pylist(), weighted)
                total = counts if total is None else total + counts
            if total is not None:
                at = np.flatnonzero(total)
                millionths = np.rint(total[at] * 1e6).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(millionths)], names=["piece", "n"])

        parts = words.select("word").mapInArrow(expect, "piece long, n long")
        counts = prior * first
        # A row per piece of the vocabulary at most.
        for row in parts.groupBy("piece").agg(F.sum("n").alias("n")).collect():
            counts[row["piece"]] += row["n"] / 1e6
        logs = np.log(counts / counts.sum())
    return logs


def _word_table(
    counted: DataFrame, pieces: Broadcast[Pieces], logs: np.ndarray, n: int, v: int, ends: int
) -> DataFrame:
    """``word, total, known, base, score, lattice``: logarithms to base ten for one occurrence of each word."""
    # One occurrence more than there are, shared by the end and by the pieces, so that neither is impossible.
    seen = v - (1 if ends else 0)
    mass, left = n + 1.0, DISCOUNT * seen + 0.5
    end, base_mass = (ends + 0.5) / mass, n + 0.5 * (v + 1)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weighted = pieces.value.weighted(logs)
        for batch in batches:
            words = batch.column("word").to_pylist()
            c = batch.column("c").to_numpy().astype(float)
            is_end = np.fromiter((w == _END for w in words), dtype=bool, count=len(words))
            spelling = spelled(words, weighted)
            with np.errstate(divide="ignore"):
                own = np.log(np.maximum(c - DISCOUNT, 0.0) / mass)
            score = np.logaddexp(own, np.log(left / mass) + spelling)
            score[is_end] = np.log(end)
            lattice = np.where(is_end, np.log(end), np.log1p(-end) + spelling)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("word"),
                    batch.column("total"),
                    pa.array(c > 0),
                    pa.array(np.log10((c + 0.5) / base_mass)),
                    pa.array(score / _LOG10),
                    pa.array(lattice / _LOG10),
                ],
                names=["word", "total", "known", "base", "score", "lattice"],
            )

    return counted.select("word", "total", "c").mapInArrow(
        weigh, "word binary, total long, known boolean, base double, score double, lattice double"
    )


def _frequent(words: DataFrame) -> DataFrame:
    """The most frequent words, by classes of occurrences, as long as they keep to ``FREQUENT`` and ``FREQUENT_BYTES``."""
    grade = F.floor(F.log2("total") * 8)
    classes = words.groupBy(grade.alias("grade")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("word")).alias("bytes")
    )
    n = size = 0
    least = None
    # Eight classes for each doubling: a few hundred rows.
    for row in classes.orderBy(F.desc("grade")).collect():
        n, size = n + row["n"], size + row["bytes"]
        if n > FREQUENT or size > FREQUENT_BYTES:
            break
        least = row["grade"]
    return words.where(grade >= least) if least is not None else words.where("false")


class _Known:
    """The frequent words as a dictionary of places into arrays; built once in a worker."""

    def __init__(self, frame: pa.Table) -> None:
        self.words = frame.column("word").combine_chunks()
        self.values = np.column_stack([frame.column(c).to_numpy().astype(float) for c in ("known", "base", "score", "lattice")])

    @cached_property
    def place(self) -> dict[bytes, int]:
        return {w: i for i, w in enumerate(self.words.to_pylist())}

    @cached_property
    def padded(self) -> np.ndarray:
        return np.vstack([self.values, np.zeros(4)])


def score_texts(
    docs: DataFrame, pieces: Pieces, held_out: Column, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, lattice_score`` of every row.

    The model learns from the rows that are not ``held_out``. ``base_score`` is add-half smoothing of words,
    ``score`` the logarithm of the summed weight of all paths, ``lattice_score`` the same without the arcs over whole
    words. A null text is an empty one, which has only its end; repeated rows are texts of their own; an empty
    table gives no rows. Without training rows all words are spelled by pieces at their first weights. Other
    columns are not read.
    """
    spark = docs.sparkSession
    counted = stage_table(word_counts(docs, text_col, ~held_out), "words")
    seen = counted.agg(
        F.coalesce(F.sum("c"), F.lit(0)), F.count_if(F.col("c") > 0), F.coalesce(F.max(F.when(F.col("word") == _END, F.col("c"))), F.lit(0))
    )
    n, v, ends = seen.first()
    shared = spark.sparkContext.broadcast(pieces)
    logs = fit_pieces(counted.where((F.col("c") > 0) & (F.col("word") != _END)), shared)
    words = stage_table(_word_table(counted, shared, logs, n, v, ends), "scored_words")
    known = spark.sparkContext.broadcast(_Known(_frequent(words).drop("total").toArrow()))
    sums = ("n_known", "base_score", "score", "lattice_score")

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, values = known.value.place, known.value.padded
        last = len(values) - 1
        for batch in batches:
            numbers, totals, rare, rare_n, offsets = [], [], [], [], [0]
            for text in batch.column("text").to_pylist():
                tokens = words_of(text)
                tokens.append(_END)
                found = np.fromiter(map(place.get, tokens, repeat(last)), dtype=np.int64, count=len(tokens))
                totals.append(values[found].sum(axis=0))
                numbers.append(len(tokens))
                others = Counter(tokens[i] for i in np.flatnonzero(found == last))
                rare.extend(others)
                rare_n.extend(others.values())
                offsets.append(len(rare))
            totals = np.array(totals).reshape(-1, 4)
            offsets = pa.array(offsets, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row"),
                    batch.column("doc_id"),
                    batch.column("held_out"),
                    pa.array(numbers, pa.int64()),
                    *[pa.array(totals[:, j]) for j in range(4)],
                    pa.ListArray.from_arrays(offsets, pa.array(rare, pa.binary())),
                    pa.ListArray.from_arrays(offsets, pa.array(rare_n, pa.int64())),
                ],
                names=["row", "doc_id", "held_out", "n_tokens", *sums, "rare", "rare_n"],
            )

    rows = docs.select(
        F.col(id_col).alias("doc_id"), held_out.alias("held_out"), F.col(text_col).cast("binary").alias("text")
    )
    rows = spread(rows).withColumn("row", F.monotonically_increasing_id())
    id_type = docs.schema[id_col].dataType.simpleString()
    schema = (
        f"row long, doc_id {id_type}, held_out boolean, n_tokens long, "
        + ", ".join(f"{c} double" for c in sums)
        + ", rare array<binary>, rare_n array<long>"
    )
    texts = stage_table(rows.mapInArrow(look_up, schema), "texts")
    others = texts.select("row", F.explode(F.arrays_zip("rare", "rare_n")).alias("o")).select(
        "row", F.col("o.rare").alias("word"), F.col("o.rare_n").alias("times")
    )
    names = ("known", "base", "score", "lattice")
    joined = others.join(words.select("word", *[F.col(c).cast("double").alias(f"one_{c}") for c in names]), "word")
    nothing = [F.lit(None).cast(t).alias(c) for c, t in (("doc_id", id_type), ("held_out", "boolean"), ("n_tokens", "long"))]
    parts = joined.select("row", *nothing, *[(F.col(f"one_{c}") * F.col("times")).alias(s) for c, s in zip(names, sums)])
    added = texts.drop("rare", "rare_n").union(parts).groupBy("row").agg(
        F.max("doc_id").alias("doc_id"),
        F.max("held_out").alias("held_out"),
        F.max("n_tokens").alias("n_tokens"),
        *[F.sum(c).alias(c) for c in sums],
    )
    return added.select(
        "doc_id",
        "held_out",
        "n_tokens",
        F.round("n_known").cast("long").alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        "base_score",
        "score",
        "lattice_score",
    )


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether crc32 of the id modulo 5 is 1; a row without an id is learnt from."""
    return F.coalesce(crc_of_id(doc_id) % 5 == 1, F.lit(False))


def op11_lattice_lm(spark: SparkSession, sf_dir: str, vocabulary: str = VOCABULARY) -> DataFrame:
    return score_texts(table(spark, sf_dir, "documents"), read_vocabulary(vocabulary), held_out())
