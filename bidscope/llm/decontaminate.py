"""Benchmark decontamination: token windows of the documents against a hash set of benchmark n-grams.

DataFrame functions only. The windows of the benchmark are distinct rows of a staged table. Up to
``SET_LIMIT`` of them travel to every task as one constant hash set: each document is scanned in its own row,
and only windows whose hash is in the set become rows, with their words, which the join with the
benchmark's windows verifies. A larger benchmark takes the other way: the document's windows become rows and
are joined by a 128-bit digest, and Spark chooses the join by the size of the staged table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bidscope.llm.common import lower_ascii, table
from bidscope.session import stage_table

N = 10
#: Windows in the constant hash set: 16 bytes each in a task, so 0.8 MB at most.
SET_LIMIT = 50_000
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(lower_ascii(F.coalesce(text, F.lit(""))), _BETWEEN), "")


def benchmark_windows(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", n: int = N) -> DataFrame:
    """``gram, len, items``: the distinct windows of ``n`` words and the items they occur in.

    An item of fewer words is one window; one without words, or a null text, has none.
    """
    items = benchmark.select(F.col(id_col).alias("item_id"), words_of(F.col(text_col)).alias("w")).where("size(w) > 0")
    grams = items.select(
        "item_id",
        F.explode(
            F.expr(
                f"transform(sequence(1, greatest(size(w) - {n} + 1, 1)), "
                f"i -> struct(array_join(slice(w, i, {n}), ' ') AS gram, least(size(w), {n}) AS len))"
            )
        ).alias("x"),
    )
    return grams.groupBy(F.col("x.gram").alias("gram"), F.col("x.len").alias("len")).agg(
        F.collect_set(F.col("item_id").cast("string")).alias("items")
    )


def _starts(length: int) -> str:
    """The places, from 0, at which a window of that many words starts."""
    return f"IF(size(w) >= {length}, sequence(0, size(w) - {length}), CAST(array() AS array<int>))"


def _in_set(words: DataFrame, grams: DataFrame, lengths: list[int]) -> DataFrame:
    """``hits`` of every row by the constant hash sets: first the first two words, then the whole window."""
    found = []
    parts = F.split("gram", " ")
    hashed = grams.select(
        "len",
        F.xxhash64(parts).alias("whole"),
        F.xxhash64(F.slice(parts, 1, 2)).alias("head"),
    ).collect()  # SET_LIMIT rows at most
    for length in lengths:
        whole = sorted({r["whole"] for r in hashed if r["len"] == length})
        head = sorted({r["head"] for r in hashed if r["len"] == length})

        def met(i: Column, width: int, known: list[int]) -> Column:
            return F.xxhash64(*[F.get("w", i + k) for k in range(width)]).isin(known)

        kept = F.filter(F.expr(_starts(length)), lambda i: met(i, min(2, length), head) & met(i, length, whole))  # noqa: B023
        found.append(
            F.transform(
                kept,
                lambda i: F.struct(
                    i.alias("pos"),
                    F.lit(length).alias("len"),  # noqa: B023
                    F.array_join(F.slice("w", i + 1, F.lit(length)), " ").alias("gram"),  # noqa: B023
                ),
            )
        )
    return words.withColumn("hits", F.concat(*found))


def _by_join(words: DataFrame, grams: DataFrame, lengths: list[int]) -> DataFrame:
    """``id, n_words, pos, len, items`` of every window that occurs, where the benchmark is large."""
    windows = ", ".join(
        f"transform({_starts(n)}, i -> struct(i AS pos, {n} AS len, "
        f"unhex(md5(array_join(slice(w, i + 1, {n}), ' '))) AS digest))"
        for n in lengths
    )
    rows = words.select("uid", F.explode(F.expr(f"concat({windows})")).alias("x"))
    known = grams.select(F.unhex(F.md5("gram")).alias("known"), F.col("len").alias("l"), "items")
    return rows.join(known, (F.col("x.digest") == F.col("known")) & (F.col("x.len") == F.col("l"))).select(
        "uid", F.col("x.pos").alias("pos"), F.col("x.len").alias("len"), "items"
    )


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    bench_text: str = "text",
    n: int = N,
    set_limit: int = SET_LIMIT,
) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated, spans`` of every row.

    ``spans`` are the hit words as (first, last) numbers from 0, merged. A null text has no words and is not
    contaminated; null ids stay; repeated rows stay, each with its own result; null item ids count as no item;
    an empty table gives no rows, an empty benchmark clean ones. Columns of ``docs`` beyond id and text are not read.
    """
    grams = stage_table(benchmark_windows(benchmark, item_col, bench_text, n), "benchmark_windows")
    size = grams.agg(F.count(F.lit(1)), F.sort_array(F.collect_set("len"))).first()
    count, lengths = size[0], size[1]
    words = docs.select(F.col(id_col).alias("doc_id"), words_of(F.col(text_col)).alias("w"))
    if count > set_limit:
        words = stage_table(words.withColumn("uid", F.monotonically_increasing_id()), "words")
        narrow = words.select("uid", "doc_id", F.size("w").alias("n_words"))
        hits = _by_join(words, grams, lengths)
    else:
        found = _in_set(words, grams, lengths) if lengths else words.withColumn(
            "hits", F.expr("CAST(array() AS array<struct<pos:int,len:int,gram:string>>)")
        )
        found = found.select("doc_id", F.size("w").alias("n_words"), "hits")
        narrow = stage_table(found.withColumn("uid", F.monotonically_increasing_id()), "hits")
        rows = narrow.select("uid", F.explode("hits").alias("x")).select("uid", "x.*")
        hits = rows.join(grams.select("gram", "items"), "gram").select("uid", "pos", "len", "items")
    per_doc = hits.groupBy("uid").agg(
        F.collect_set(F.struct("pos", "len")).alias("windows"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("item_ids"),
    )
    covered = "array_sort(array_distinct(flatten(transform(windows, x -> sequence(x.pos, x.pos + x.len - 1)))))"
    per_doc = per_doc.select("uid", F.expr(covered).alias("hit"), "item_ids")
    joined = narrow.select("uid", "doc_id", "n_words").join(per_doc, "uid", "left")
    # The hits are sorted, so a span opens or closes where the place beside is no neighbour.
    first = "filter(hit, (x, i) -> i = 0 OR get(hit, i - 1) < x - 1)"
    last = "filter(hit, (x, i) -> i = size(hit) - 1 OR get(hit, i + 1) > x + 1)"
    none = F.expr("CAST(array() AS array<string>)")
    return joined.select(
        "doc_id",
        F.col("n_words").cast("long").alias("n_words"),
        F.expr("CAST(IF(hit IS NULL, 0, size(hit)) AS BIGINT)").alias("n_hit"),
        F.expr("CAST(IF(item_ids IS NULL, 0, size(item_ids)) AS BIGINT)").alias("n_items"),
        F.sha2(F.array_join(F.coalesce("item_ids", none), ","), 256).alias("items_sha256"),
        F.col("hit").isNotNull().alias("contaminated"),
        F.expr(
            f"IF(hit IS NULL, CAST(array() AS array<struct<first:int,last:int>>), "
            f"zip_with({first}, {last}, (a, b) -> struct(a AS first, b AS last)))"
        ).alias("spans"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows in which a benchmark window occurs; all columns stay.

    The test is a filter in the row: hashes first, then the window's words themselves. With a benchmark beyond
    ``SET_LIMIT`` the contaminated texts are found by join and anti-joined by the digest of the text.
    """
    grams = stage_table(benchmark_windows(benchmark), "benchmark_windows")
    size = grams.agg(F.count(F.lit(1)), F.sort_array(F.collect_set("len"))).first()
    if not size[0]:
        return docs
    # The row number keeps the filter from being pushed below the words, where each test would split the text anew.
    packed = docs.select(
        F.struct("*").alias("row"), words_of(F.col(text_col)).alias("w"), F.monotonically_increasing_id().alias("once")
    )
    if size[0] <= SET_LIMIT:
        known = [r["gram"] for r in grams.select("gram").collect()]  # SET_LIMIT rows at most
        found = _in_set(packed, grams, size[1])
        clean = ~F.exists("hits", lambda x: x.getField("gram").isin(known))
        return found.where(clean & (F.col("once") >= 0)).select("row.*")
    texts = stage_table(packed.select(F.md5(F.col(f"row.{text_col}")).alias("uid"), "w"), "words")
    bad = _by_join(texts, grams, size[1]).select(F.col("uid").alias("bad")).distinct()
    digest = packed.withColumn("digest", F.md5(F.col(f"row.{text_col}")))
    return digest.join(bad, F.col("digest") == F.col("bad"), "left_anti").select("row.*")


def remove_spans(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text``: each document's words outside the hit spans, joined by spaces; clean texts as they are.

    Each text is searched once however many rows have it; rows with one id and several texts are cut each by its own.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("body"), F.md5(text_col).alias("digest"))
    texts = rows.where("digest IS NOT NULL").dropDuplicates(["digest"])
    spans = contamination(texts, benchmark, "digest", "body").where("contaminated").select("doc_id", "spans")
    cut = rows.join(spans, F.col("digest") == F.col("doc_id"), "left")
    rest = "filter(w, (x, i) -> NOT exists(spans, s -> i BETWEEN s.first AND s.last))"
    return cut.withColumn("w", words_of(F.col("body"))).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("spans").isNull(), F.col("body")).otherwise(F.array_join(F.expr(rest), " ")).alias("text"),
    )


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("spans")


OP5_SQL = r"""
WITH b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
bw AS (SELECT item_id, len(w) AS size, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM b),
dw AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM d),
bl AS (SELECT item_id, pos, size,
  list(word) OVER (PARTITION BY item_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND 9 FOLLOWING) AS l FROM bw),
g AS (SELECT DISTINCT item_id, len(l) AS n, array_to_string(l, ' ') AS gram FROM bl
  WHERE len(l) = 10 OR (pos = 1 AND size < 10)),
dl AS (SELECT doc_id, pos,
  list(word) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND 9 FOLLOWING) AS l FROM dw),
x AS (SELECT doc_id, pos, n, array_to_string(l[1:n], ' ') AS gram FROM dl, (SELECT DISTINCT n FROM g) WHERE len(l) >= n),
h AS (SELECT doc_id, pos, x.n, item_id FROM x JOIN g USING (gram)),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT DISTINCT doc_id, unnest(range(pos, pos + n)) AS p FROM h) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM h) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""
