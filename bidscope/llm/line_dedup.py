"""Exact deduplication of runs of lines by a suffix array over line ids.

DataFrame functions only. The corpus is one sequence of line ids per document. Prefix doubling sorts its
suffixes: round 0 ranks the lines that occur more than once, and round j + 1 ranks the pairs (rank of round j
here, rank of round j 2^j lines further on). A rank is the place in the suffix array at which the interval of
suffixes with that prefix starts, so suffixes of one rank are one interval with a longest common prefix of
2^j lines or more. Suffixes that are alone in their interval leave the rounds, which shrink quickly.

A repeated run counts from ``MIN_WORDS`` words on. Each line starts one shortest window with that many words and
ends one; every repeated run of enough words is the union of such windows. The interval of a window of m lines is
named by two ranks of round floor(log2 m), at its start and at 2^j lines before its end. In each interval the
first occurrence (smallest id, then text, then line) stays; all others are deleted, and overlapping or adjacent windows of
a document merge into the maximal run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bidscope.llm.common import table
from bidscope.operators.ranking import running_totals
from bidscope.session import stage_table

#: Words a repeated run must have; words are what single blanks separate.
MIN_WORDS = 50
_DOC = ["doc_id", "uid"]


def _lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, uid, i, line, words, n``: a row per line; rows that repeat id and text are one document."""
    texts = docs.where(F.col(text_col).isNotNull()).select(
        F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("uid"), F.split(text_col, "\n", -1).alias("l")
    )
    rows = texts.select(*_DOC, F.size("l").alias("n"), F.posexplode("l").alias("i", "line"))
    blanks = F.length("line") - F.length(F.replace("line", F.lit(" "), F.lit("")))
    lines = rows.select(
        *_DOC,
        "i",
        "n",
        F.unhex(F.md5("line")).alias("line"),
        F.when(F.col("line") == "", 0).otherwise(blanks + 1).alias("words"),
    )
    ids = docs.agg(F.count(F.lit(1)), F.countDistinct(id_col)).first()
    return stage_table(lines if ids[0] == ids[1] else lines.dropDuplicates([*_DOC, "i"]), "lines")


def _ranked(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose ``keys`` occur more than once, with ``r``: where the interval starts in the suffix array."""
    classes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    ranks = running_totals(classes, [F.col(k) for k in keys], {"upto": F.col("members")})
    named = stage_table(ranks.select(*keys, (F.col("upto") - F.col("members")).alias("r")), "ranks")
    return stage_table(rows.join(named, keys).select(*_DOC, "i", "r"), "suffixes")


def _windows(lines: DataFrame, min_words: int) -> DataFrame:
    """``doc_id, uid, s, m``: the shortest windows of ``min_words`` words that start, or end, at each line."""
    # One more place per document, behind its last line, so that every window has a place behind it.
    places = lines.select(*_DOC, "i", "n", "words").union(
        lines.where("i = 0").select(*_DOC, F.col("n").alias("i"), "n", F.lit(0))
    )
    before = Window.partitionBy(*_DOC).orderBy("i").rowsBetween(Window.unboundedPreceding, -1)
    counted = places.withColumn("c", F.coalesce(F.sum("words").over(before), F.lit(0)))
    by_words = Window.partitionBy(*_DOC).orderBy("c")
    found = counted.withColumns(
        {
            "to": F.last("i").over(by_words.rangeBetween(0, min_words - 1)),
            "from": F.first("i").over(by_words.rangeBetween(1 - min_words, 0)) - 1,
        }
    )
    starting = found.where("to < n AND i < n").select(*_DOC, F.col("i").alias("s"), (F.col("to") - F.col("i") + 1).alias("m"))
    ending = found.where("`from` >= 0").select(*_DOC, F.col("from").alias("s"), (F.col("i") - F.col("from")).alias("m"))
    return starting.union(ending).distinct()


def _level(m: Column) -> Column:
    return F.floor(F.log2(m.cast("double"))).cast("int")


def repeated_runs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS
) -> DataFrame:
    """``doc_id, uid, runs``: the line runs (first, last; from 0) to delete of each document that has any.

    ``uid`` is the xxhash64 of the text. A null text has no lines. Documents with a null id come after all others.
    """
    lines = _lines(docs, id_col, text_col)
    windows = stage_table(_windows(lines, min_words), "windows")
    longest = windows.agg(F.max("m")).first()[0] or 0
    level, suffixes = 0, _ranked(lines.select(*_DOC, "i", "line"), ["line"])
    levels = suffixes.withColumn("j", F.lit(0))
    while 2 ** (level + 1) <= longest:
        ahead = Window.partitionBy(*_DOC).orderBy("i").rangeBetween(2**level, 2**level)
        pairs = suffixes.select(*_DOC, "i", F.col("r").alias("a"), F.first("r").over(ahead).alias("b")).where("b IS NOT NULL")
        suffixes = _ranked(pairs, ["a", "b"])
        if suffixes.isEmpty():
            break
        level += 1
        levels = levels.union(suffixes.withColumn("j", F.lit(level)))

    def rank(name: str, place: str) -> DataFrame:
        return levels.select(F.col("doc_id").alias("d"), F.col("uid").alias("u"), F.col("i").alias(place), "j", F.col("r").alias(name))

    def at(place: str) -> list[Column]:
        return [F.col("doc_id").eqNullSafe(F.col("d")), F.col("uid") == F.col("u"), F.col("jj") == F.col("j"), F.col(place) == F.col("at")]

    wide = windows.withColumn("jj", _level(F.col("m"))).withColumn("e", (F.col("s") + F.col("m") - F.pow(F.lit(2), "jj")).cast("int"))
    known = wide.join(rank("a", "at"), at("s")).drop("d", "u", "j", "at").join(rank("b", "at"), at("e")).drop("d", "u", "j", "at")
    known = stage_table(known.select(*_DOC, "s", "m", "a", "b"), "known")
    spot = F.struct(F.col("doc_id").isNull().alias("x"), "doc_id", "uid", "s")
    first = known.groupBy("m", "a", "b").agg(F.count(F.lit(1)).alias("members"), F.min(spot).alias("first"))
    first = stage_table(first.where("members > 1").drop("members"), "intervals")
    later = known.join(first, ["m", "a", "b"]).where(~spot.eqNullSafe(F.col("first")))
    return _merged(later.select(*_DOC, "s", (F.col("s") + F.col("m") - 1).alias("e")).distinct())


def _merged(spans: DataFrame) -> DataFrame:
    order = Window.partitionBy(*_DOC).orderBy("s", "e")
    reach = F.max("e").over(order.rowsBetween(Window.unboundedPreceding, -1))
    starts = spans.withColumn("opens", F.coalesce(F.col("s") > reach + 1, F.lit(True)).cast("int"))
    runs = starts.withColumn("run", F.sum("opens").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    merged = runs.groupBy(*_DOC, "run").agg(F.min("s").alias("first"), F.max("e").alias("last"))
    return merged.groupBy(*_DOC).agg(F.sort_array(F.collect_list(F.struct("first", "last"))).alias("runs"))


def dedup_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS
) -> DataFrame:
    """``row`` (a struct of all columns as they were), ``lines``, ``deleted``, ``kept``: the text without later copies.

    Every row comes back: a document that repeats others throughout keeps an empty text, and a null text stays
    null with no lines. Rows that repeat id and text are one document and get the same result. Null ids count as
    the largest. Copies within a document count too, overlapping ones included: of a run that follows itself the
    first stays. An empty table gives no rows. Names of other columns do not matter.
    """
    runs = stage_table(repeated_runs(docs, id_col, text_col, min_words), "runs").toDF("d", "u", "runs")
    packed = docs.select(
        F.struct("*").alias("row"), F.col(id_col).alias("doc_id"), F.col(text_col).alias("body")
    ).withColumn("uid", F.xxhash64("body"))
    # Merged at every size: a broadcast while the runs are few would only put off the shuffle of the texts.
    joined = packed.join(runs.hint("merge"), F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("uid") == F.col("u")), "left")
    lines = F.split("body", "\n", -1)
    rest = F.filter(lines, lambda _, i: ~F.exists("runs", lambda r: (i >= r["first"]) & (i <= r["last"])))
    gone = F.aggregate("runs", F.lit(0), lambda n, r: n + r["last"] - r["first"] + 1)
    return joined.select(
        "row",
        "doc_id",
        F.when(F.col("body").isNull(), 0).otherwise(F.size(lines)).cast("long").alias("lines"),
        F.coalesce(gone, F.lit(0)).cast("long").alias("deleted"),
        F.when(F.col("runs").isNull(), F.col("body")).otherwise(F.array_join(rest, "\n")).alias("kept"),
    )


def without_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with its columns, later copies of line runs deleted; documents with no line left go.

    A column ``n_chars``, where there is one, follows the text. Texts that were empty or null from the start stay.
    """
    found = dedup_lines(docs, id_col, text_col).where("deleted = 0 OR deleted < lines")
    fields = []
    for name in docs.columns:
        if name == text_col:
            fields.append(F.col("kept").alias(name))
        elif name == "n_chars":
            kept = F.length("kept").cast(docs.schema[name].dataType)
            fields.append(F.when(F.col("deleted") > 0, kept).otherwise(F.col("row")[name]).alias(name))
        else:
            fields.append(F.col("row")[name].alias(name))
    return found.select(*fields)


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = dedup_lines(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.col("lines").alias("n_lines"), F.col("deleted").alias("n_deleted"), F.col("kept").alias("text"))


OP2_SQL = f"""
WITH d AS (SELECT doc_id, text, string_split(text, chr(10)) AS l FROM documents),
x AS (SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) - 1 AS i FROM d),
w AS (SELECT doc_id, i, line, md5(line) AS id,
  CASE WHEN line = '' THEN 0 ELSE length(line) - length(replace(line, ' ', '')) + 1 END AS words FROM x),
c AS (SELECT *, sum(words) OVER (PARTITION BY doc_id ORDER BY i) AS upto FROM w),
s AS (
  SELECT a.doc_id, a.i AS s, min(b.i) AS e FROM c a JOIN c b ON a.doc_id = b.doc_id AND b.i >= a.i
    AND b.upto >= a.upto - a.words + {MIN_WORDS} GROUP BY ALL
  UNION
  SELECT b.doc_id, max(a.i) AS s, b.i AS e FROM c a JOIN c b ON a.doc_id = b.doc_id AND b.i >= a.i
    AND b.upto >= a.upto - a.words + {MIN_WORDS} GROUP BY b.doc_id, b.i),
k AS (SELECT s.doc_id, s, e, string_agg(id, ' ' ORDER BY i) AS content
  FROM s JOIN w ON w.doc_id = s.doc_id AND i BETWEEN s AND e GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY content ORDER BY doc_id, s) AS copy FROM k),
gone AS (SELECT DISTINCT doc_id, unnest(range(s, e + 1)) AS i FROM r WHERE copy > 1),
t AS (SELECT w.doc_id, count(*) AS n_lines, count(gone.i) AS n_deleted,
  string_agg(line, chr(10) ORDER BY w.i) FILTER (gone.i IS NULL) AS rest
  FROM w LEFT JOIN gone ON gone.doc_id = w.doc_id AND gone.i = w.i GROUP BY w.doc_id)
SELECT doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_deleted, 0) AS n_deleted,
  CASE WHEN text IS NULL THEN NULL ELSE coalesce(rest, '') END AS text
FROM documents LEFT JOIN t USING (doc_id)
"""
