"""Lattice scores, prefix tries and whitening against brute force, and on odd rows."""

import hashlib
import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from bidscope.llm import lattice_lm, prefix_trie, whitening
from bidscope.llm.common import table
from bidscope.llm.queries import queries
from tests.conftest import SF_DIR

LONG = " ".join(f"w{i % 977}x" for i in range(30_000))
SCORED = [("▁th", -2.0), ("e", -3.0), ("▁the", -4.0), ("h", -5.0), ("he", -6.0), ("re", -7.0), ("▁", -8.0), ("é", -9.0)]


def segmentations(codes, known):
    if not codes:
        yield ()
    for j in range(1, len(codes) + 1):
        if codes[:j] in known:
            for rest in segmentations(codes[j:], known):
                yield (codes[:j], *rest)


def spell_all(word, weights):
    """Weights of all segmentations of a word."""
    return [(s, math.prod(weights[c] for c in s)) for s in segmentations((257, *word), weights)]


def test_words_are_worth_the_sum_over_all_their_segmentations():
    pieces = lattice_lm.pieces_of(SCORED, ranked=True)
    weights = dict(zip(pieces.codes, np.exp(pieces.logs)))
    assert abs(sum(weights.values()) - 1) < 1e-12
    words = [b"the", b"there", "thé".encode(), b"x", b"hehe", b"\x00e", b""]
    want = [math.log(sum(w for _, w in spell_all(word, weights))) for word in words]
    assert np.allclose(lattice_lm.spelled(words, pieces), want, rtol=1e-12)
    counts = np.zeros(len(pieces.codes))
    for word in words:
        ways = spell_all(word, weights)
        for way, weight in ways:
            for piece in way:
                counts[pieces.codes.index(piece)] += weight / sum(w for _, w in ways)
    assert np.allclose(lattice_lm.expected(words, pieces), counts, atol=1e-12)


def test_long_words_take_blocks(monkeypatch):
    pieces = lattice_lm.pieces_of(SCORED, ranked=True)
    words = [b"there" * 400, b"a", b"the" * 90, b"b" * 700]
    whole, counts = lattice_lm.spelled(words, pieces), lattice_lm.expected(words, pieces)
    monkeypatch.setattr(lattice_lm, "_CELLS", 64)
    assert np.allclose(lattice_lm.spelled(words, pieces), whole, rtol=1e-12)
    assert np.allclose(lattice_lm.expected(words, pieces), counts, rtol=1e-9)


def brute_scores(rows, pieces, rounds):
    """Every text scored from counts in plain Python; ``rows`` are (doc_id, text)."""
    held = [i is not None and zlib.crc32(str(i).encode()) % 5 == 1 for i, _ in rows]
    tokens = [[*(t or "").encode().lower().split(), b""] for _, t in rows]
    c = Counter(w for words, out in zip(tokens, held) if not out for w in words)
    n, v = sum(c.values()), len(c)
    weights = dict(zip(pieces.codes, np.exp(pieces.logs)))
    first = dict(weights)
    for _ in range(rounds):
        counts = {p: lattice_lm.PRIOR * w for p, w in first.items()}
        for word in c:
            if word:
                ways = spell_all(word, weights)
                whole = sum(w for _, w in ways)
                for way, weight in ways:
                    for piece in way:
                        counts[piece] += weight / whole
        weights = {p: x / sum(counts.values()) for p, x in counts.items()}
    d, seen = lattice_lm.DISCOUNT, v - (b"" in c)

    def score(w):
        if not w:
            return (c[w] + 0.5) / (n + 1)
        return max(c[w] - d, 0) / (n + 1) + (d * seen + 0.5) / (n + 1) * sum(x for _, x in spell_all(w, weights))

    out = []
    for (i, _), words, is_held in zip(rows, tokens, held):
        base = sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in words)
        known = sum(c[w] > 0 for w in words)
        out.append((i, is_held, len(words), known, n, base, sum(math.log10(score(w)) for w in words)))
    return out


TEXTS = [
    (1, "the there THE"), (2, None), (3, ""), (None, "he re\tthé"), (4, "there"), (4, "there"), (11, "hehe x the"),
    (12, "\x0bre\x1cthe the "), (13, "the the the"), (14, "há ha"), (15, "ree"), (16, " \n "), (21, "Éé e"),
]


@pytest.mark.parametrize("frequent", [3, 1 << 18])
def test_text_scores_equal_brute_force(spark, monkeypatch, frequent):
    # With few frequent words most go through the join.
    monkeypatch.setattr(lattice_lm, "FREQUENT", frequent)
    pieces = lattice_lm.pieces_of(SCORED, ranked=True)
    docs = spark.createDataFrame([(i, t, "r", 7, "s") for i, t in TEXTS], "doc_id long, text string, row string, score int, word string")
    got = lattice_lm.score_texts(docs, pieces, lattice_lm.held_out()).collect()
    want = brute_scores(TEXTS, pieces, lattice_lm.ROUNDS)
    assert any(w[1] for w in want) and len(got) == len(want)
    order = lambda r: (r[0] is None, r[0] or 0, r[2])
    for a, b in zip(sorted(got, key=order), sorted(want, key=order)):
        assert tuple(a)[:5] == b[:5]
        assert abs(a["base_score"] - b[5]) < 1e-9 and abs(a["score"] - b[6]) < 1e-5


def test_text_scores_of_odd_tables(spark):
    pieces = lattice_lm.pieces_of(SCORED, ranked=True)
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert lattice_lm.score_texts(empty, pieces, lattice_lm.held_out()).count() == 0
    one = spark.createDataFrame([(5, LONG)], "doc_id long, text string")
    (row,) = lattice_lm.score_texts(one, pieces, F.lit(True)).collect()
    assert (row["n_tokens"], row["n_known"], row["train_tokens"], row["base_score"]) == (30_001, 0, 0, 0.0)
    assert math.isfinite(row["score"])


def test_lattice_query_counts_and_learns(spark):
    rows = {r["doc_id"]: r for r in queries()["op11_lattice_lm"](spark, SF_DIR).collect()}
    texts = [(r["doc_id"], r["text"]) for r in table(spark, SF_DIR, "documents").collect()]
    held = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i, _ in texts}
    tokens = {i: [*(t or "").encode().lower().split(), b""] for i, t in texts}
    c = Counter(w for i, words in tokens.items() if not held[i] for w in words)
    n, v = sum(c.values()), len(c)
    assert len(rows) == len(texts)
    for i, words in tokens.items():
        base = sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in words)
        assert rows[i][:5] == (i, held[i], len(words), sum(c[w] > 0 for w in words), n)
        assert abs(rows[i]["base_score"] - base) < 1e-6 * abs(base)
    # On texts that nothing was learnt from, learning the words and the weights of the pieces both help.
    out = [r for r in rows.values() if r["held_out"]]
    pieces = lattice_lm.read_vocabulary(lattice_lm.VOCABULARY)
    words = [w for r in out for w in tokens[r["doc_id"]] if w]
    untaught = lattice_lm.spelled(words, pieces).sum() / math.log(10)
    assert sum(r["score"] for r in out) > sum(r["lattice_score"] for r in out) > untaught


def brute_trie(rows):
    """The nodes of the rebuilt conversations, member by member; ``rows`` are (conv_id, turn, role, text)."""
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = (role or "").encode(), (text or "").encode()
            digest = hashlib.sha256(f"{len(role)}:".encode() + role + text).hexdigest()
            own.setdefault(conv, []).append((turn is not None, turn or 0, role, digest, text))
    turns = {c: [(t[2], t[4]) for t in sorted(ts)] for c, ts in own.items()}
    rebuilt = {}
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 9
        rebuilt[c] = tuple(turns.get(c - int(math.fmod(c, 5)), [])[:h] + turns[c][h:])
    members = {}
    for c, seq in rebuilt.items():
        for d in range(len(seq) + 1):
            members.setdefault(seq[:d], []).append(c)
    children = Counter(k[:-1] for k in members if k)
    leaves, saved = Counter(), Counter()
    for key, of in members.items():
        for d in range(len(key) + 1):
            leaves[key[:d]] += children[key] == 0
            saved[key[:d]] += (len(of) - 1) * (len(key[-1][1]) if key else 0)
    out = []
    for key, of in members.items():
        ends = ",".join(str(c) for c in sorted(of) if len(rebuilt[c]) == len(key))
        out.append(
            (
                min(of), len(key), min(members[key[:-1]]) if key else None, len(of), children[key], leaves[key],
                saved[key], hashlib.sha256(ends.encode()).hexdigest(),
            )
        )
    return sorted(out, key=lambda r: (r[1], r[0]))


TURNS = "conv_id long, turn long, role string, text string, hi string, place int"
ODD_TURNS = [
    (1, 0, "user", "hello"), (1, 1, "assistant", "héllo"), (2, 0, "user", "hello"), (2, 1, "assistant", "héllo"),
    (3, None, None, None), (3, 0, "user", "hello"), (3, 0, "user", "bye"), (3, 0, "user", "bye"), (None, 0, "user", "x"),
    (5, 0, "user", ""), (5, 1, "user", "x" * 100_000), (6, 7, "user", "hello"), (-4, 0, "user", "hello"), (7, 0, "", ""),
    *[(10, k, "user", f"t{k}") for k in range(40)], *[(11, k, "user", f"t{k}") for k in range(40)],
    *[(12, k, "user", f"t{min(k, 25)}") for k in range(45)], *[(14, k, "user", f"u{k}") for k in range(3)],
]


@pytest.mark.parametrize("height, block", [(8, 4096), (2, 4), (3, 7)])
def test_trie_equals_brute_force(spark, monkeypatch, height, block):
    monkeypatch.setattr(prefix_trie, "HEIGHT", height)
    frame = spark.createDataFrame([(*r, "h", 3) for r in ODD_TURNS], TURNS)
    got = sorted((tuple(r) for r in prefix_trie.rebuilt_trie(frame, block).collect()), key=lambda r: (r[1], r[0]))
    assert got == brute_trie(ODD_TURNS)


def test_trie_of_hot_nodes_and_of_nothing(spark):
    rows = [(c, t, "user", f"same {t}") for c in range(700) for t in range(3)]
    frame = spark.createDataFrame([(*r, "h", 3) for r in rows], TURNS)
    got = sorted((tuple(r) for r in prefix_trie.rebuilt_trie(frame).collect()), key=lambda r: (r[1], r[0]))
    assert got == brute_trie(rows)
    assert prefix_trie.rebuilt_trie(frame.where("false")).count() == 0


def brute_whitening(vectors, components):
    x = np.floor(64 * np.array(vectors, dtype=float)).astype(np.int64).astype(object) + 1_000_000
    n, s = len(x), x.sum(axis=0)
    centred = (n * x - s).astype(float) / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1][:components], axes[:, ::-1][:, :components]
    deviations = [int(((n * row - s) ** 2).sum()) for row in x]
    return n, deviations, centred @ axes / np.sqrt(values), values / np.trace(centred.T @ centred / n)


def test_whitening_equals_eigenvectors(spark):
    got = queries()["op13_whitening"](spark, SF_DIR).toPandas().sort_values(["vec_id", "component"])
    rows = table(spark, SF_DIR, "embeddings").toPandas().sort_values("vec_id")
    n, deviations, whitened, explained = brute_whitening(rows["embedding"].tolist(), 32)
    assert (got["n"] == n).all() and got["deviation"].to_numpy().reshape(n, 32)[:, 0].tolist() == deviations
    own = got["whitened"].to_numpy().reshape(n, 32)
    assert np.abs(own * np.sign((own * whitened).sum(axis=0)) - whitened).max() < 1e-8
    assert np.allclose(got["explained"].to_numpy()[:32], explained, rtol=1e-10)
    assert 0 <= got["identity_error"].max() < 1e-10


def test_whitening_of_odd_rows(spark):
    schema = "vec_id long, embedding array<float>, x string, component string, n string"
    rng = np.random.default_rng(3)
    good = [(i if i else None, rng.normal(size=5).tolist()) for i in range(30)]
    good += [good[4], good[4], (99, [1e6, -1e6, 0.0, 0.5, -0.5])]
    bad = [(50, None), (51, [1.0, None, 0.0, 0.0, 0.0]), (52, [float("nan")] * 5), (53, [float("-inf"), 0.0, 0.0, 0.0, 0.0])]
    frame = spark.createDataFrame([(i, v, "x", "c", "n") for i, v in good + bad], schema)
    got = whitening.whiten(frame, components=3).toPandas()
    n, deviations, _, explained = brute_whitening([np.float32(v) for _, v in good], 3)
    assert len(got) == 3 * n and got["vec_id"].isna().sum() == 3
    assert sorted(got[got["component"] == 1]["deviation"]) == sorted(deviations)
    assert np.allclose(sorted(set(got["explained"]), reverse=True), explained, rtol=1e-4)
    assert got["identity_error"].max() < 1e-4
    assert whitening.whiten(frame.where("false")).count() == 0
    assert whitening.whiten(frame.where("vec_id = 50")).count() == 0
    assert whitening.whiten(frame.where("vec_id = 7")).count() == 0
    with pytest.raises(ValueError, match="entries"):
        whitening.whiten(frame.union(spark.createDataFrame([(1, [1.0], "", "", "")], schema)))


def test_components_without_variance_are_left_out(spark):
    rows = [(i, [float(i), 2.0 * i, 0.0, float(i % 3)]) for i in range(50)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = whitening.whiten(frame).toPandas()
    assert sorted(set(got["component"])) == [1, 2] and abs(got["explained"].unique().sum() - 1) < 1e-9


def test_filter_converges_on_a_flat_spectrum(spark):
    rng = np.random.default_rng(5)
    vectors = rng.normal(size=(3000, 120)) * np.linspace(1.0, 1.4, 120)
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    got = whitening.whiten(frame, components=8).toPandas().sort_values(["vec_id", "component"])
    _, _, whitened, explained = brute_whitening(vectors, 8)
    own = got["whitened"].to_numpy().reshape(-1, 8)
    assert np.abs(own * np.sign((own * whitened).sum(axis=0)) - whitened).max() < 1e-6
    assert np.allclose(got["explained"].to_numpy()[:8], explained, rtol=1e-10)
