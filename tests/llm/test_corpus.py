"""The corpus operators on small frames: defined results for odd input, and brute force where there is no SQL."""

import base64
import gzip
import hashlib
import re
import time

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from bidscope.llm import (
    common,
    decontaminate,
    fingerprint,
    html_text,
    langid,
    line_dedup,
    mixing,
    quality,
    simhash_dedup,
    toxicity,
    warc,
)
from bidscope.llm.queries import oracle_sql, queries
from checks.compare import connect, difference
from tests.conftest import CHECK_DIR

DOCS = "doc_id long, text string, lang string, source string, n_chars long, fp string, row string, UID string"
LONG = " ".join(f"w{i % 977}x" for i in range(30_000))


def make(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), "f", "r", "u") for i, t in rows], DOCS)


ODD = [(1, None), (2, ""), (None, "alpha beta"), (3, "alpha beta"), (3, "alpha beta"), (4, LONG), (5, "...")]


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_sql(spark, name):
    result = queries()[name](spark, CHECK_DIR)
    got = (result.columns, [tuple(r) for r in result.collect()])
    answer = connect(CHECK_DIR).execute(oracle_sql()[name])
    assert difference(got, ([c[0] for c in answer.description], answer.fetchall())) is None


def test_line_runs(spark):
    run = "\n".join(" ".join(f"{k}{j}" for j in range(20)) for k in "abc")
    rows = [(1, f"x\n{run}\ny"), (2, f"z\n{run}\nx"), (3, run), (None, f"{run}\nq"), (4, None), (5, ""), (6, "x\ny")]
    got = line_dedup.dedup_lines(make(spark, rows)).collect()
    kept = {r["doc_id"]: r["kept"] for r in got}
    assert kept == {1: f"x\n{run}\ny", 2: "z\nx", 3: "", None: "q", 4: None, 5: "", 6: "x\ny"}
    left = line_dedup.without_repeated_lines(make(spark, rows)).collect()
    assert sorted(r["doc_id"] or 0 for r in left) == [0, 1, 2, 4, 5, 6] and left[0].asDict().keys() >= {"UID", "row"}
    assert line_dedup.dedup_lines(make(spark, rows).where("false")).count() == 0


def _components(fps):
    roots = list(range(len(fps)))

    def find(a):
        while roots[a] != a:
            a = roots[a]
        return a

    for a in range(len(fps)):
        for b in range(a):
            if (fps[a] ^ fps[b]).bit_count() <= 2:
                low, high = sorted((find(a), find(b)))
                roots[high] = low
    return [find(a) for a in range(len(fps))]


@pytest.mark.parametrize("bucket", [2, 64])
def test_links_against_brute_force(spark, bucket):
    rng = np.random.default_rng(3)
    fps = set()
    for center in rng.integers(0, 1 << 63, 6).tolist():
        fps |= {center ^ (1 << int(i)) ^ (1 << int(j)) for i, j in rng.integers(0, 63, (25, 2))}
    fps = sorted(fps | {0, 1, 1 << 31, 1 << 32})
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    links = simhash_dedup.links(spark.createDataFrame([(f,) for f in signed], "fp long"), bucket)
    found = {r["vertex"]: r["root"] for r in simhash_dedup.components(links).collect()}
    roots = _components(fps)
    groups, wanted = {}, {}
    for f, r in zip(signed, roots):
        groups.setdefault(found.get(f, f), set()).add(f)
        wanted.setdefault(r, set()).add(f)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, wanted.values()))


def test_crowded_fingerprints_are_linked_without_a_join(spark):
    """A joined table of groups is small as a file and was broadcast at 160 times that size."""
    center = 0x8123_4567_89AB_CDEF
    flips = [(), (0,), (63,), (0, 63), (5, 9), (31, 32), (31,), (62, 63), (7, 8, 9), (20, 21, 22, 23), (1, 2, 3, 63)]
    fps = sorted({center ^ sum(1 << bit for bit in flip) for flip in flips} | {0, 1 << 63, 1, 1 << 63 | 1, 6, 1 << 62 | 1 << 40})
    signed = {simhash_dedup._signed(f): f for f in fps}
    links = simhash_dedup._cliques(spark.createDataFrame([(f,) for f in signed], "fp long"))
    assert "Join" not in links._jdf.queryExecution().toString()
    pairs = {(signed[r["u"]], signed[r["v"]]) for r in links.collect()}
    assert all(0 < (u ^ v).bit_count() <= 2 for u, v in pairs)
    roots = {f: f for f in fps}
    for _ in fps:
        for u, v in pairs:
            roots[u] = roots[v] = min(roots[u], roots[v])
    assert [fps.index(roots[f]) for f in fps] == _components(fps)


def test_simhash_odd_rows(spark):
    got = simhash_dedup.near_duplicates(make(spark, ODD)).collect()
    assert len(got) == len(ODD)
    by = {(r["doc_id"], r["fingerprint"]): r["component_id"] for r in got}
    assert by[1, "0" * 16] == by[2, "0" * 16] == 1
    alike = f"{simhash_dedup.simhash64('alpha beta'):016x}"
    assert by[None, alike] == by[3, alike] == 3
    kept = simhash_dedup.drop_near_duplicates(make(spark, ODD)).collect()
    assert sorted(r["doc_id"] for r in kept) == [1, 3, 4, 5]
    assert simhash_dedup.near_duplicates(make(spark, ODD).where("false")).count() == 0


def _brute_simhash(text):
    """The fingerprint from the contract's words, bit by bit."""
    words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64(s, seed=42).intdigest() for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def _near_texts():
    """Texts of which some are within two bits of each other, made by editing long texts a little."""
    rng = np.random.default_rng(5)
    texts = []
    for center in range(12):
        words = [f"c{center}w{i}" for i in range(int(rng.integers(300, 900)))]
        for edits in (0, 0, 1, 1, 2, 3, 5, 40):
            edited = list(words)
            for at in rng.integers(0, len(words), edits):
                edited[at] = f"x{rng.integers(1 << 30)}"
            texts.append(" ".join(edited))
    return [*texts, "one two", "One  TWO", "one two three", "", " ", "İÀ b\x0bc\x1cd e"]


@pytest.mark.parametrize("bucket", [2, 64])
def test_one_text_of_each_component_stays(spark, bucket):
    texts = _near_texts()
    fps = [_brute_simhash(t) for t in texts]
    assert fps == [simhash_dedup.simhash64(t) for t in texts]
    roots = _components(fps)
    docs = make(spark, list(enumerate(texts)))
    kept = simhash_dedup.drop_near_duplicates(docs, bucket=bucket)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == sorted(set(roots))
    differing = {(fps[i], fps[r]) for i, r in enumerate(roots) if fps[i] != fps[r]}
    assert differing and len(set(roots)) < len(set(texts))


def test_rows_of_one_id_stay_by_their_own_component(spark):
    rows = [(3, "a b c d"), (5, "A b c d"), (5, "q r s t u"), (None, "x y z"), (None, "X y  z"), (None, "a b c d"), (None, "m n")]
    got = simhash_dedup.drop_near_duplicates(make(spark, rows)).collect()
    assert sorted((r["doc_id"] or 0, r["text"].lower().split()) for r in got) == [
        (0, ["m", "n"]), (0, ["x", "y", "z"]), (3, ["a", "b", "c", "d"]), (5, ["q", "r", "s", "t", "u"])
    ]


def test_decontamination_odd_rows_and_both_ways(spark):
    words = [f"t{i}" for i in range(12)]
    bench = spark.createDataFrame(
        [(1, " ".join(words)), (2, "Solo"), (3, None), (None, "nil"), (4, "...")], "item_id long, text string"
    )
    docs = make(spark, [*ODD, (6, "x " + " ".join(words).upper() + " y"), (7, "a solo b"), (8, " ".join(words[:9]))])
    for limit in (decontaminate.SET_LIMIT, 0):
        got = {r["doc_id"]: r for r in decontaminate.contamination(docs, bench, set_limit=limit).collect()}
        assert (got[6]["n_hit"], got[6]["n_items"], got[6]["spans"]) == (12, 1, [(1, 12)])
        assert got[6]["items_sha256"] == hashlib.sha256(b"1").hexdigest()
        assert (got[7]["n_hit"], got[8]["contaminated"], got[1]["n_words"]) == (1, False, 0)
    kept = decontaminate.drop_contaminated(docs, bench)
    assert kept.columns == docs.columns and sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 1, 2, 3, 3, 4, 5, 8]
    assert decontaminate.contamination(docs, bench.where("false")).where("contaminated").count() == 0


def test_spans_are_removed_row_by_row(spark):
    bench = spark.createDataFrame([(1, "one two"), (2, "six seven")], "item_id long, text string")
    rows = [(1, "a one two six seven b"), (1, "a x one two"), (1, "a x one two"), (2, "One b"), (None, "six seven"), (3, None)]
    got = decontaminate.remove_spans(make(spark, rows), bench).collect()
    assert sorted(((r["doc_id"] or 0, r["text"]) for r in got), key=str) == sorted(
        [(1, "a b"), (1, "a x"), (1, "a x"), (2, "One b"), (0, ""), (3, None)], key=str
    )
    spans = decontaminate.contamination(make(spark, [(1, "one two a one two six seven c one two")]), bench).first()["spans"]
    assert spans == [(0, 1), (3, 6), (8, 9)]


def test_sample_of_a_tiny_share(spark):
    many = spark.range(3_000_000)
    assert 1 <= common.bounded_sample(many, F.col("id"), 2).count() <= 8
    assert 900 <= common.bounded_sample(many, F.col("id"), 1_000).count() <= 1_100


def test_sample_keeps_rare_classes(spark):
    many = spark.range(200_000).selectExpr(
        "id", "CASE WHEN id < 3 THEN 'rarest' WHEN id < 2000 THEN 'rare' WHEN id % 50 > 0 THEN 'frequent' END AS c"
    )
    drawn = common.bounded_sample_per_class(many, "c", F.col("id"), 2_000, 100)
    counts = {r["c"]: r["count"] for r in drawn.groupBy("c").count().collect()}
    assert counts.keys() == {"rarest", "rare", "frequent"}
    assert counts["rarest"] == 3 and 60 <= counts["rare"] <= 140 and 1_800 <= counts["frequent"] <= 2_200
    known = many.where("c IS NOT NULL")
    plain = common.bounded_sample(known, F.col("id"), 2_000).where("c = 'frequent'")
    assert plain.exceptAll(drawn).isEmpty() and drawn.where("c = 'frequent'").exceptAll(plain).isEmpty()
    assert common.bounded_sample_per_class(many, "c", F.col("id"), 200_000, 100).count() == known.count()
    assert common.bounded_sample_per_class(many.limit(0), "c", F.col("id"), 10, 1).isEmpty()


def test_fingerprints(spark):
    got = fingerprint.fingerprints(make(spark, ODD)).collect()
    order = [LONG, "alpha beta", "alpha beta", "", "", "alpha beta"]
    at = next(r for r in got if r["doc_id"] == 4)
    half = len(LONG) // 2
    assert at["edited_sha256"] == hashlib.sha256((LONG[:-half] + order[1]).encode()).hexdigest()
    last = next(r for r in got if r["doc_id"] is None)
    assert len(got) == len(ODD) and last["edited_sha256"] == hashlib.sha256(("alpha" + "...").encode()).hexdigest()
    a, b = fingerprint.sketch(LONG), fingerprint.sketch(LONG + " more")
    assert fingerprint.from_text(fingerprint.as_text(a)) == a and fingerprint.likeness(a, b) > 0.9
    assert fingerprint.fingerprints(make(spark, ODD).where("false")).count() == 0
    one = fingerprint.fingerprints(make(spark, [(9, "ab")])).first()
    assert one["edited_sha256"] == hashlib.sha256(b"aa").hexdigest()


def test_main_text():
    long = "Some words of the article that go on for quite a while, until the end of this sentence is reached."
    page = (
        f"<html><head><title>t</title><style>p>a{{}}</style></head><body><div class='cookie-notice'><p>{long}</p></div><nav>{long}</nav>"
        f"<div id=main><h2>A &amp; B</h2><p>{long}<br>x&nbsp;y</p><script>var a='</p>'</script><p>ok</p></div>"
        f"<ul><li><a href=x>{long}</a></li></ul><div class=comments><p>{long}</p></div><footer>{long}</footer>"
    )
    assert html_text.main_text(page) == f"A & B\n{long} x y\nok"
    assert html_text.main_text("<body><nav>menu</nav><article><p>hi</p><div class=ad>no</div>yo</article>") == "hi\nyo"
    assert html_text.main_text(None) == html_text.main_text("") == html_text.main_text("<p></p><!--") == ""
    assert html_text.main_text("a < b") == "a < b"
    # A letter whose lower case is longer must not shift what is cut out behind it.
    odd = "İ" * 40
    assert html_text.main_text(f"<p>{odd} {long}</p><NAV>x<a>y</a></NAV><p>{long}</p>").endswith(f"{odd} {long}\n{long}")


def test_main_text_beside_article_cards():
    long = "Some words of the article that go on for quite a while, until the end of this sentence is reached."
    cards = "".join(f"<article><h3>Card {i}</h3><p>A teaser.</p></article>" for i in range(4))
    assert html_text.main_text(f"<div><h1>A</h1><p>{long}</p><p>{long}</p></div>{cards}") == f"A\n{long}\n{long}"
    # Short text beside what was cut out stays where its container has text that is kept.
    page = f"<div>Slogan</div><nav>menu</nav><div><h1>A</h1><div class=ad>x</div><p>{long}</p><aside>y</aside><p>End.</p></div>"
    assert html_text.main_text(page) == f"A\n{long}\nEnd."
    assert html_text.main_text(f"<p>Slogan</p><article><h1>A</h1><div class=ad>x</div><p>{long}</p></article><p>{long}</p>") == f"A\n{long}"


def test_surge_and_dive_decide_on_pages_without_names(monkeypatch):
    long = "Some words of the article that go on for quite a while, until the end of this sentence is reached."
    bare = f"<body><div>Buy shoes now</div><div><h1>A</h1><p>{long}</p><p>ok</p><p>{long}</p></div><div>(c) 2024 example</div></body>"
    divs = (
        f"<body><table><tr><td>Offers<td>today</table><div><span>Buy</span> shoes now</div><div><div><h2>A</h2></div><div>{long}</div>"
        f"<div>ok</div><div>{long}</div></div><div>(c) 2024<br>example</div><div><div>More</div><div>Even more</div></div></body>"
    )
    want = f"A\n{long}\nok\n{long}"
    assert html_text.main_text(bare) == want and html_text.main_text(divs).endswith(want)
    assert "(c)" not in html_text.main_text(divs) and "More" not in html_text.main_text(divs)
    # Without a threshold for the windows nothing of this is left out: it is they that decide.
    monkeypatch.setattr(html_text, "SURGE", 0)
    assert html_text.main_text(bare) == f"Buy shoes now\n{want}\n(c) 2024 example" and "Even more" in html_text.main_text(divs)


def test_short_pages_keep_their_text():
    assert html_text.main_text("<div>Title</div><div>Short text.</div>") == "Title\nShort text."
    assert html_text.main_text("<div><h1>Title</h1></div><div><p>Short.</p><p>Text.</p></div>") == "Title\nShort.\nText."


def test_large_pages_take_linear_time():
    pages = ["<div class=ad>x" * 70_000, "<div class=ad>x</div>" * 50_000, "<div class=sidebar-layout>x" * 30_000 + "</div>" * 30_000]
    pages += ["".join(f"<x{i} class=ad>y" for i in range(60_000)), "<p>words of it " * 70_000]
    for page in pages:
        start = time.process_time()
        html_text.main_text(page)
        assert len(page) > 900_000 and time.process_time() - start < 6


def test_elements_end_where_their_own_tag_does():
    long = "Some words of the article that go on for quite a while, until the end of this sentence is reached."
    nested = f"<p>{long}</p><div class=ad>a<div>b</div><!-- </div> --><script>'</div>'</script>c</div><p>{long}</p>"
    assert html_text.main_text(nested) == f"{long}\n{long}"
    assert html_text.main_text(f"<div class=ad title='</div>'>a</div><p>{long}</p>") == long


def test_pages_of_odd_tables(spark):
    schema = "page_id long, url string, html string, page string, text string, n_chars int"
    rows = [(1, "u", "<p>é a</p>", "p", "t", 9), (1, "u", "<p>é a</p>", "p", "t", 9), (None, None, None, None, None, None), (2, "v", "", "", "", 0)]
    got = html_text.extract(spark.createDataFrame(rows, schema))
    assert sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(
        map(str, [(1, "u", "é a", 3), (1, "u", "é a", 3), (None, None, "", 0), (2, "v", "", 0)])
    )
    assert html_text.extract(spark.createDataFrame([], schema)).count() == 0


def test_toxicity_held_out(spark):
    got = queries()["op9_toxicity"](spark, CHECK_DIR)
    labels = common.table(spark, CHECK_DIR, "labels").where("toxic IS NOT NULL").select("doc_id", "toxic")
    held = got.where("held_out").join(labels, "doc_id").toPandas()
    toxic = held["toxic"] > 0
    assert toxic.sum() >= 3 and (~toxic).sum() > 50
    pairs = held["score"].to_numpy()[toxic.to_numpy()][:, None] - held["score"].to_numpy()[~toxic.to_numpy()][None, :]
    assert ((pairs > 0) + 0.5 * (pairs == 0)).mean() > 0.8
    assert (held["predicted"] == (held["score"] >= 0.5)).all() and held["score"].between(0, 1).all()


def test_main_text_in_wrappers_with_marked_names():
    long = "Some words of the article that go on for quite a while, until the end of this sentence is reached."
    for name in ("layout with-sidebar", "no-sidebar", "has-header", "sidebar-layout", "site-search"):
        assert html_text.main_text(f"<div class='{name}'><article><p>{long}</p></article></div>") == long
        assert html_text.main_text(f"<div class='{name}'><p>{long}</p></div>") == long
    assert html_text.main_text(f"<div id='content-sidebar-wrap'><p>{long}</p><div class='sidebar'>{long[:40]}</div></div>") == long
    head = f"<div class='article-header'><h1>A</h1><p>Lead.</p></div><section class='related-work'><p>{long}</p></section>"
    rest = f"<section class='share-prices'><p>B</p></section><section class=search><p>C</p></section><p>{long}</p><p>{long}</p>"
    cut = "<div class='related-posts'>D</div><div class='ad-slot'>E</div><div class='share-buttons'>F</div><div class=ad>G</div>"
    assert html_text.main_text(f"<article>{head}{rest}{cut}</article>") == f"A\nLead.\n{long}\nB\nC\n{long}\n{long}"
    talk = f"<section id=comments><article class=comment><p>{long}</p></article><p>{long}</p><p>{long}</p></section>"
    assert html_text.main_text(f"<div><p>{long}</p></div>{talk}") == long


def test_warc_round_trip(spark, tmp_path):
    tricky = "é\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n" * 3
    rows = [(1, "http://a/\r\nx", tricky), (2, "u", tricky), (3, None, None), (4, "v", ""), (None, "w", tricky), (5, "z", LONG), (5, "z", LONG)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    path = f"file://{tmp_path}/warc"
    warc.write_archives(pages, path)
    found = warc.captures(warc.read_records(spark, path)).collect()
    assert len(found) == len(rows)
    stored = {r["page_id"]: r["response"]["payload"] for r in found if r["response"]["type"] == "response"}
    assert stored == {2: tricky.encode(), 4: b"", 5: LONG.encode()} and all(r["response"]["intact"] is not False for r in found)
    pages.write.parquet(f"{tmp_path}/pages.parquet")
    got = {r["page_id"]: r for r in warc.op10_warc(spark, str(tmp_path)).collect()}
    assert (got[1]["record_type"], got[1]["refers_to"], got[3]["refers_to"], got[None]["refers_to"]) == ("revisit", 2, 4, 2)
    assert got[1]["payload_digest"] == base64.b32encode(hashlib.sha1(tricky.encode()).digest()).decode()
    assert got[1]["payload_bytes"] == len(tricky.encode()) and got[5]["refers_to"] is None


def test_warc_query_equals_brute_force(spark):
    pages = [(r["page_id"], (r["html"] or "").encode()) for r in common.table(spark, CHECK_DIR, "pages").collect()]
    keeper = {}
    for page_id, body in pages:
        keeper[body] = max(page_id, keeper.get(body, page_id))
    got = {r["page_id"]: r for r in queries()["op10_warc"](spark, CHECK_DIR).collect()}
    assert len(got) == len(pages)
    for page_id, body in pages:
        kept = keeper[body] == page_id
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        want = (len(body), digest, "response" if kept else "revisit", None if kept else keeper[body])
        assert tuple(got[page_id][c] for c in ("payload_bytes", "payload_digest", "record_type", "refers_to")) == want


def _warc(kind, record_id, block, *headers, length=None):
    lines = ["WARC/1.0", f"WARC-Type: {kind}", f"WARC-Record-ID: {record_id}", *headers, f"Content-Length: {len(block) if length is None else length}"]
    return "\r\n".join(lines).encode("latin-1") + b"\r\n\r\n" + block + b"\r\n\r\n"


def test_archives_of_other_writers(spark, tmp_path):
    sha = base64.b32encode(hashlib.sha1(b"hello world").digest()).decode()
    records = [
        b"\r\n",
        _warc("warcinfo", "<i>", b"software: other\r\n"),
        _warc("response", "<a>", b"HTTP/1.0 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n5;x=y\r\nhello\r\n6\r\n world\r\n0\r\n\r\n",
              "WARC-Target-URI: <http://a/\xe9>", f"WARC-Payload-Digest: sha1:{sha}", "WARC-Concurrent-To: <ar>"),
        _warc("request", "<ar>", b"GET / HTTP/1.0\r\n\r\n", "WARC-Target-URI: http://a/\xe9"),
        _warc("response", "<b>", b"HTTP/1.1 404 Not\nContent-Type: text/html; charset=latin-1\n\nna\xefve", "WARC-Target-URI: http://b/",
              "X-Folded: one\r\n two", f"WARC-Payload-Digest: sha1:{sha}"),
        _warc("metadata", "<bm>", b"page-id: seven\r\n", "WARC-Concurrent-To: <b>", "WARC-Target-URI: http://b/"),
        _warc("response", "<c>", b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\nnot chunked", "WARC-Payload-Digest: md5:abc"),
        _warc("resource", "<d>", b"\x00\xff", f"WARC-Payload-Digest: SHA1:{hashlib.sha1(bytes([0, 255])).hexdigest()}"),
        _warc("revisit", "<e>", b"", "WARC-Refers-To: <a>"),
        _warc("response", "<f>", b"HTTP/1.1 200 OK\r\n\r\ncut", length=10_000),
        _warc("response", "<never>", b""),
    ]
    (tmp_path / "warc").mkdir()
    (tmp_path / "warc" / "plain.warc").write_bytes(b"".join(records))
    # One gzip member a record, as others write them, cut off in the last one.
    members = [gzip.compress(_warc("response", f"<g{i}>", b"HTTP/1.1 200 OK\r\n\r\n" + b"x" * 50_000 + bytes([i]))) for i in range(3)]
    (tmp_path / "warc" / "members.warc.gz").write_bytes(b"".join(members)[:-30])
    (tmp_path / "warc" / "odd.warc").write_bytes(b"<html>no archive</html>")
    (tmp_path / "warc" / "empty.warc").write_bytes(b"")
    (tmp_path / "warc" / "long.warc").write_bytes(_warc("response", "<h>", b"", length="many"))
    found = warc.read_records(spark, f"file://{tmp_path}/warc").collect()
    by = {r["record_id"]: r for r in found}
    assert (by["<a>"]["payload"], by["<a>"]["intact"], by["<a>"]["status"], by["<a>"]["target"]) == (b"hello world", True, 200, "http://a/é")
    assert (by["<b>"]["payload"], by["<b>"]["intact"], by["<b>"]["status"]) == (b"na\xefve", False, 404)
    assert (by["<c>"]["payload"], by["<c>"]["intact"]) == (b"not chunked", None)
    assert (by["<d>"]["payload"], by["<d>"]["intact"], by["<d>"]["status"]) == (b"\x00\xff", True, None)
    assert (by["<e>"]["payload_bytes"], by["<e>"]["payload_digest"], by["<e>"]["refers_to"]) == (None, None, "<a>")
    assert by["<f>"]["broken"] == "truncated" and by["<f>"]["payload"].startswith(b"cut") and "<never>" not in by
    assert by["<g1>"]["broken"] is None and len(by["<g1>"]["payload"]) == 50_001
    assert sorted(r["broken"] for r in found if r["broken"]) == ["no WARC record", "no length", "truncated", "unreadable compression"]
    lean = {r["record_id"]: r for r in warc.read_records(spark, f"file://{tmp_path}/warc", payloads=False).collect()}
    assert lean["<a>"]["payload"] is None and lean["<a>"]["payload_bytes"] == 11 and lean["<a>"]["intact"]
    whole = {r["capture"]: r for r in warc.captures(warc.read_records(spark, f"file://{tmp_path}/warc")).collect()}
    assert whole["<a>"]["request"]["record_id"] == "<ar>" and whole["<a>"]["metadata"] is None
    assert whole["<b>"]["metadata"]["record_id"] == "<bm>" and whole["<b>"]["page_id"] is None and "<i>" not in whole


def test_warc_of_nothing_and_of_clashing_names(spark, tmp_path):
    pages = spark.createDataFrame(
        [(1, "u", "x", 5, "d", True), (2, "u", "x", 6, "e", False)],
        "page_id long, url string, html string, digest long, body string, revisit boolean",
    )
    pages.where("false").write.parquet(f"{tmp_path}/none/pages.parquet")
    assert warc.op10_warc(spark, f"{tmp_path}/none").count() == 0
    pages.write.parquet(f"{tmp_path}/two/pages.parquet")
    got = {r["page_id"]: (r["record_type"], r["refers_to"]) for r in warc.op10_warc(spark, f"{tmp_path}/two").collect()}
    assert got == {1: ("revisit", 2), 2: ("response", None)}


def test_languages_held_out(spark):
    got = queries()["op8_langid"](spark, CHECK_DIR)
    langs = spark.read.parquet(f"{CHECK_DIR}/documents.parquet").select("doc_id", "lang")
    right = got.where("held_out").join(langs, "doc_id").selectExpr("avg(int(lang = lang_pred))").first()[0]
    assert right > 0.95
    known = {"en": np.ones(langid.DIMENSIONS) / 32}
    odd = {r["doc_id"]: r["lang_pred"] for r in langid.identify(make(spark, ODD), known).collect()}
    assert odd[1] == odd[2] == odd[5] == "und" and odd[3] == "en"
    assert langid.identify(make(spark, ODD), {}).where("lang_pred <> 'und'").count() == 0


def test_toxicity_learns_subwords(spark):
    rng = np.random.default_rng(1)
    words = ["".join(rng.choice(list("abcdefgh"), 6)) for _ in range(400)]
    texts = [" ".join(rng.choice(words, 60)) for _ in range(300)]
    marks = [int(i % 3 == 0) for i in range(300)]
    model = toxicity.fit([f"{t} nastyword {t}" if m else f"{t} {t}" for t, m in zip(texts, marks)], marks)
    assert model.score(f"{texts[0]} nastywords") > 0.5 > model.score(texts[1])
    assert toxicity.score(make(spark, ODD), model).count() == len(ODD)
    assert toxicity.fit([], []).score("x") < 0.5 < toxicity.fit(["a"], [1]).score("x")


def test_quality_scores_every_row(spark):
    got = queries()["op4_quality"](spark, CHECK_DIR)
    marks = spark.read.parquet(f"{CHECK_DIR}/labels.parquet").select("doc_id", "quality")
    right = got.where("held_out").join(marks, "doc_id").selectExpr("avg(int(quality = predicted))").first()[0]
    assert got.count() == 1000 and right > 0.88
    rows = quality.features(make(spark, ODD), marks.where("false"))
    assert quality.co_train(rows) is None
    assert [r["score"] for r in quality.score(rows, None).collect()] == [0.5] * len(ODD)


def test_mix_meets_targets(spark):
    docs = spark.read.parquet(f"{CHECK_DIR}/documents.parquet")
    got = mixing.mix(docs, docs, "lang", {"en": 1, "de": 1, "fr": 1, "es": 1}, ["doc_id"]).toPandas()
    mass = np.array(got.mix_posterior.tolist()) * (got.n_tokens * got.mix_rate).to_numpy()[:, None]
    assert np.abs(mass.sum(axis=0) / got.n_tokens.sum() - 0.25).max() < 1e-5 and got.mix_rate.min() >= 0
    hard = mixing.mix(docs, docs, "lang", {"es": 1}, ["doc_id"]).toPandas()
    assert hard.mix_rate.min() >= 0 and hard[hard.mix_domain == "en"].mix_rate.median() < 0.05
    assert got.mix_error.max() < 1e-5 and hard.mix_error.nunique() == 1
    odd = mixing.mix(make(spark, ODD), make(spark, ODD).where("false")).collect()
    assert [r["mix_rate"] for r in odd] == [1.0] * len(ODD)


def test_pipeline(spark):
    stages = dict(corpus_pipeline.STAGES)
    docs = spark.read.parquet(f"{CHECK_DIR}/documents.parquet")
    for name, stage in list(stages.items())[:-1]:
        assert stage(spark, docs, CHECK_DIR).columns == docs.columns, name
    assert 600 < corpus_pipeline.run(spark, CHECK_DIR).count() < 950


def test_rates_are_the_nonnegative_least_squares_fit(spark):
    rng = np.random.default_rng(9)
    tokens = rng.integers(1, 400, 300)
    p = rng.dirichlet([0.6, 0.6, 0.6], 300)
    rows = spark.createDataFrame([(int(t), q.tolist()) for t, q in zip(tokens, p)], "tokens long, p array<double>")
    targets = np.array([0.7, 0.2, 0.1])
    moves, got = mixing.fit_rates(rows, targets.tolist())
    rated = rows.withColumn("rate", mixing._rate(moves)).toPandas()
    mass = (np.array(rated.p.tolist()) * (rated.tokens * rated.rate).to_numpy()[:, None]).sum(axis=0)
    assert np.allclose(mass, got) and np.abs(mass / tokens.sum() - targets).max() < 1e-3 and rated.rate.min() >= 0
    # Projected gradient in plain numpy, from the same start.
    gram = (p * tokens[:, None]).T @ p
    rate = np.ones(300)
    for _ in range(len(moves)):
        rate = np.maximum(0, rate - p @ np.linalg.solve(gram, (p * (tokens * rate)[:, None]).sum(axis=0) - targets * tokens.sum()))
    assert np.allclose(rate, rated.rate.to_numpy(), atol=1e-5)


def test_mix_emits_copies_and_keeps_clashing_columns(spark):
    docs = make(spark, [*ODD, *[(i, "der die das und" if i % 3 else "the of and to") for i in range(10, 90)]])
    docs = docs.withColumn("lang", F.when(F.col("text").startswith("der"), "de").otherwise("en")).withColumn("mix_rate", F.lit("own"))
    mixed = mixing.mix(docs, docs, "lang")
    assert {"mix_rate_in", "mix_rate", "mix_error"} <= set(mixed.columns) and mixed.count() == docs.count()
    wanted = {r["doc_id"]: r["mix_copies"] for r in mixed.collect() if (r["doc_id"] or 0) >= 10}
    copies = mixing.sampled(mixed).where("doc_id >= 10").groupBy("doc_id").agg(F.count("*").alias("n"), F.max("mix_copy").alias("m"))
    assert {r["doc_id"]: (r["n"], r["m"]) for r in copies.collect()} == {i: (n, n) for i, n in wanted.items() if n}
    assert mixing.mix(docs.where("false"), docs, "lang").count() == 0
