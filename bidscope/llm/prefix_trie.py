"""The prefix trie of conversations, rolled up by bands of depths.

A node is a distinct sequence of first turns. Its identity is a sum: every turn has a hash of its place, role
and text, and the hash of a sequence is the sum of its turns' hashes, four words of 32 bits each. Sums are taken
by places, block by block, so no task walks a long conversation, and nodes come from one grouped aggregate.

Subtree totals go through bands of ``HEIGHT`` depths. Inside its band a node explodes to its ancestors, which are
``HEIGHT`` at most and come along as an array. The roots of the bands are then a trie of their own, with the
totals of their bands as weights and a depth ``HEIGHT`` times smaller, rolled up the same way. Their completed
totals go to the nodes above them, within one band again. Rounds are logarithmic in the depth, and a node becomes
2 x ``HEIGHT`` rows at most.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bidscope.llm.common import crc_of_id, table
from bidscope.operators.ranking import running_totals, with_position
from bidscope.session import stage_table

#: Depths in a band.
HEIGHT = 8
#: Places that are summed in one window; longer conversations are summed block by block.
BLOCK = 4096
#: Ids in a piece of a node's list of ends.
_PIECE = 256
_WORDS = ("w0", "w1", "w2", "w3")
_WORD = 1 << 32
_KEY = ("hi", "lo")
_NO_ENDS = hashlib.sha256(b"").hexdigest()


def numbered_turns(
    conversations: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> tuple[DataFrame, DataFrame]:
    """Turns ``conv, spot, digest, bytes`` and conversations ``conv, start, n``.

    ``spot`` numbers all turns in the order of conversation, turn (null first), role and the SHA-256 of role and
    text; ``start`` is the first of a conversation. Rows are numbered by range partitions, so a long
    conversation is split. A null role or text is an empty one; turns without a conversation are left out.
    """
    role, text = F.coalesce(F.col(role_col), F.lit("")), F.coalesce(F.col(text_col), F.lit(""))
    turns = conversations.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).alias("conv"),
        F.col(turn_col).alias("turn"),
        role.alias("role"),
        F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256).alias("digest"),
        F.octet_length(text).cast("long").alias("bytes"),
    )
    order = [F.asc("conv"), F.asc_nulls_first("turn"), F.asc("role"), F.asc("digest")]
    spots = with_position(turns, order, "spot").select("conv", "spot", "digest", "bytes")
    convs = spots.groupBy("conv").agg(F.min("spot").alias("start"), F.count(F.lit(1)).alias("n"))
    return spots, stage_table(convs, "conversations")


def _rebuilt(conversations: DataFrame) -> DataFrame:
    """``conv, place, n, digest, bytes``: every turn of the rebuilt conversations, and place 0 of each.

    Conversation c begins with the first h turns of conversation c - c % 5, h being crc32(c) % 9, and goes on with its
    own turns after its first h; ``%`` has the sign of c. ``n`` is the number of turns it then has.
    """
    spots, convs = numbered_turns(conversations)
    heads = convs.select(F.col("conv").alias("base"), F.col("start").alias("base_start"), F.col("n").alias("base_n"))
    h = crc_of_id(F.col("conv")) % F.lit(9)
    plans = (
        convs.select("*", h.alias("h"), (F.col("conv") - F.col("conv") % 5).alias("base"))
        .join(heads, "base", "left")
        .withColumn("head", F.least("h", F.coalesce("base_n", F.lit(0))))
        .withColumn("total", F.col("head") + F.greatest(F.col("n") - F.col("h"), F.lit(0)))
    )
    plans = stage_table(plans, "plans")
    own = spots.join(plans.drop("base", "base_start", "base_n", "n"), "conv").select(
        "conv",
        (F.col("head") + F.col("spot") - F.col("start") + 1 - F.col("h")).alias("place"),
        F.col("total").alias("n"),
        "digest",
        "bytes",
        (F.col("spot") - F.col("start") >= F.col("h")).alias("kept"),
    )
    followers = plans.where("base_n IS NOT NULL").select(
        F.col("conv").alias("follower"), F.col("base").alias("conv"), "base_start", "head", F.col("total").alias("n")
    )
    lent = spots.where("conv % 5 = 0").join(followers, "conv").select(
        F.col("follower").alias("conv"),
        (F.col("spot") - F.col("base_start") + 1).alias("place"),
        "n",
        "digest",
        "bytes",
        (F.col("spot") - F.col("base_start") < F.col("head")).alias("kept"),
    )
    starts = plans.select(
        "conv", F.lit(0).cast("long").alias("place"), F.col("total").alias("n"), F.lit("").alias("digest"),
        F.lit(0).cast("long").alias("bytes"),
    )
    return own.union(lent).where("kept").drop("kept").union(starts)


def _keyed(turns: DataFrame, block: int) -> DataFrame:
    """``conv, place, n, bytes, hi, lo, up_hi, up_lo``: turns with the identity of their prefix and of the one before."""
    mixed = F.md5(F.concat_ws(":", "place", "digest"))
    words = {
        w: F.when(F.col("place") > 0, F.conv(F.substring("mixed", 8 * k + 1, 8), 16, 10).cast("long")).otherwise(0)
        for k, w in enumerate(_WORDS)
    }
    rows = turns.withColumn("mixed", mixed).withColumns(words).withColumn("block", F.expr(f"place div {block}"))
    rows = rows.drop("mixed", "digest")
    so_far = Window.partitionBy("conv", "block").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    if not rows.where(F.col("n") >= block).isEmpty():
        ahead = _blocks_ahead(rows.where(F.col("n") >= block))
        rows = rows.join(ahead, ["conv", "block"], "left")
    else:
        rows = rows.withColumns({f"ahead_{w}": F.lit(0).cast("long") for w in _WORDS})
    sums = {w: F.pmod(F.sum(w).over(so_far) + F.coalesce(f"ahead_{w}", F.lit(0)), F.lit(_WORD)) for w in _WORDS}
    summed = rows.select(
        "conv", "place", "n", "bytes", *[c.alias(f"sum_{w}") for w, c in sums.items()], *_WORDS
    ).withColumns({f"up_{w}": F.pmod(F.col(f"sum_{w}") - F.col(w), F.lit(_WORD)) for w in _WORDS})

    def halves(prefix: str) -> list[Column]:
        w = [F.col(f"{prefix}_{name}") for name in _WORDS]
        return [F.shiftleft(w[0], 32).bitwiseOR(w[1]), F.shiftleft(w[2], 32).bitwiseOR(w[3])]

    (hi, lo), (up_hi, up_lo) = halves("sum"), halves("up")
    return summed.select(
        "conv", "place", "n", "bytes", hi.alias("hi"), lo.alias("lo"), up_hi.alias("up_hi"), up_lo.alias("up_lo")
    )


def _blocks_ahead(rows: DataFrame) -> DataFrame:
    """For each block of a long conversation, the sums of the blocks ahead of it in that conversation."""
    totals = rows.groupBy("conv", "block").agg(*[F.pmod(F.sum(w), F.lit(_WORD)).alias(w) for w in _WORDS])
    running = running_totals(totals, [F.asc("conv"), F.asc("block")], {f"to_{w}": F.col(w) for w in _WORDS})
    running = stage_table(
        running.select("conv", "block", *[(F.col(f"to_{w}") - F.col(w)).alias(f"to_{w}") for w in _WORDS]), "blocks"
    )
    first = running.where("block = 0").select("conv", *[F.col(f"to_{w}").alias(f"from_{w}") for w in _WORDS])
    return running.join(first, "conv").select(
        "conv", "block", *[(F.col(f"to_{w}") - F.col(f"from_{w}")).alias(f"ahead_{w}") for w in _WORDS]
    )


def _with_paths(rows: DataFrame, step: int) -> DataFrame:
    """Rows of every ``step``-th depth with ``path``: the prefixes of their band from its root down to their own.

    A band has the depths from a root to the next roots, these included: a root is the last of one band and the
    first of the next, and has the path of the former.
    """
    level = rows.where(F.col("place") % step == 0).withColumn("m", F.expr(f"place div {step}"))
    band = F.expr(f"m div {HEIGHT}")
    in_bands = level.withColumn(
        "band",
        F.explode(F.when((F.col("m") % HEIGHT == 0) & (F.col("m") > 0), F.array(band, band - 1)).otherwise(F.array(band))),
    )
    down = Window.partitionBy("conv", "band").orderBy("m").rowsBetween(Window.unboundedPreceding, 0)
    with_path = in_bands.withColumn("path", F.collect_list(F.struct(*_KEY)).over(down))
    return with_path.where(f"m = 0 OR band = (m - 1) div {HEIGHT}").drop("m", "band")


def _sums(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*_KEY).agg(*[F.sum(c).alias(c) for c in ("children", "leaves", "saved")])


def _emit(nodes: DataFrame, to: Column) -> DataFrame:
    """The weights of the nodes for each prefix in ``to``; ``child`` marks the one right above."""
    return nodes.select(F.explode(to).alias("a"), "parent", "leaves", "saved").select(
        "a.hi",
        "a.lo",
        (F.col("a") == F.col("parent")).cast("long").alias("children"),
        "leaves",
        "saved",
    )


def _totals(rows: DataFrame, nodes: DataFrame, step: int, deepest: int) -> DataFrame:
    """``hi, lo, children, leaves, saved`` summed over subtrees.

    ``nodes`` has ``hi, lo, depth, path, leaves, saved`` of every ``step``-th depth, ``rows`` the turns they come from.
    """
    last = F.element_at("path", -1)
    above = F.expr("element_at(path, -2)") if step == 1 else F.lit(None).cast("struct<hi: bigint, lo: bigint>")
    nodes = nodes.withColumn("parent", F.when(F.size("path") > 1, above))
    is_root = F.col("depth") % (step * HEIGHT) == 0
    within = _emit(nodes, F.when(is_root, F.array(last)).otherwise(F.col("path")))
    if deepest < step * HEIGHT:
        return _sums(within)
    partial = stage_table(_sums(within), "band_totals")
    tops = _with_paths(rows, step * HEIGHT).groupBy(*_KEY).agg(
        F.max("place").alias("depth"), F.min_by("path", "conv").alias("path")
    )
    roots = stage_table(tops.join(partial.drop("children"), list(_KEY)), "band_roots")
    done = stage_table(_totals(rows, roots, step * HEIGHT, deepest).drop("children"), "root_totals")
    # Completed roots go to the nodes of the band above them; its own root is complete already.
    upward = nodes.where(is_root & (F.col("depth") > 0)).drop("leaves", "saved").join(done, list(_KEY))
    inner = F.slice("path", F.lit(2), F.size("path") - 2)
    flat = partial.join(done.select(*_KEY, F.lit(True).alias("is_done")), list(_KEY), "left")
    no_total = F.col("is_done").isNull().cast("long")
    return _sums(
        flat.select(*_KEY, "children", (F.col("leaves") * no_total).alias("leaves"), (F.col("saved") * no_total).alias("saved"))
        .union(done.select(*_KEY, F.lit(0).cast("long"), "leaves", "saved"))
        .union(_emit(upward, inner))
    )


def _pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sorted ends, joined in pieces of one node."""
    for batch in batches:
        cut = (batch[["hi", "lo"]] != batch[["hi", "lo"]].shift()).any(axis=1).cumsum()
        within = batch.groupby(cut).cumcount() // _PIECE
        yield (
            batch.assign(first=batch["conv"], ids=batch["conv"].astype(str))
            .groupby([cut, within], sort=False)
            .agg({"hi": "first", "lo": "first", "first": "first", "ids": ",".join})
        )


def _hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """SHA-256 of each node's pieces, which come in order; one digest is open at a time."""
    now, digest = None, None
    for batch in batches:
        out = []
        for hi, lo, ids in batch[["hi", "lo", "ids"]].itertuples(index=False, name=None):
            if (hi, lo) != now:
                if digest:
                    out.append((*now, digest.hexdigest()))
                now, digest = (hi, lo), hashlib.sha256(ids.encode())
            else:
                digest.update(b"," + ids.encode())
        yield pd.DataFrame(out, columns=["hi", "lo", "ends_sha256"])
    if digest:
        yield pd.DataFrame([(*now, digest.hexdigest())], columns=["hi", "lo", "ends_sha256"])


def _ends(rows: DataFrame) -> DataFrame:
    """``hi, lo, ends_sha256`` of the nodes at which conversations end.

    A hash of a list is one stream by its nature; the ids are sorted by ranges and joined into pieces where they
    are sorted, and the task that hashes a node's pieces holds one of them at a time.
    """
    order = [F.col("hi"), F.col("lo"), F.col("conv")]
    ends = rows.where("place = n").select("hi", "lo", "conv").repartitionByRange(*order).sortWithinPartitions(*order)
    pieces = ends.mapInPandas(_pieces, "hi long, lo long, first long, ids string")
    return pieces.repartition("hi", "lo").sortWithinPartitions("hi", "lo", "first").mapInPandas(
        _hashed, "hi long, lo long, ends_sha256 string"
    )


def prefix_trie(turns: DataFrame, block: int = BLOCK) -> DataFrame:
    """The nodes of the trie over ``turns``: ``conv, place, n, digest, bytes``, a row with place 0 for each conversation.

    Returns ``conv_id`` (smallest member), ``depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256``. Conversations without turns are members of the root alone; no conversations, no nodes.
    """
    rows = stage_table(_keyed(turns, block), "prefixes")
    nodes = _with_paths(rows, 1).groupBy(*_KEY).agg(
        F.min("conv").alias("conv_id"),
        F.max("place").alias("depth"),
        F.count(F.lit(1)).alias("n_convs"),
        F.sum((F.col("place") == F.col("n")).cast("long")).alias("n_ends"),
        F.max("bytes").alias("bytes"),
        F.max("up_hi").alias("up_hi"),
        F.max("up_lo").alias("up_lo"),
        F.min_by("path", "conv").alias("path"),
    )
    nodes = stage_table(
        nodes.withColumns(
            {
                # Childless is a node at which all its members end.
                "leaves": (F.col("n_ends") == F.col("n_convs")).cast("long"),
                "saved": (F.col("n_convs") - 1) * F.col("bytes"),
            }
        ),
        "nodes",
    )
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    totals = _totals(rows, nodes.select(*_KEY, "depth", "path", "leaves", "saved"), 1, deepest)
    parents = nodes.select(F.col("hi").alias("up_hi"), F.col("lo").alias("up_lo"), F.col("conv_id").alias("parent_conv_id"))
    below = nodes.where("depth > 0").join(parents, ["up_hi", "up_lo"]).select(*_KEY, "parent_conv_id")
    return (
        nodes.select(*_KEY, "conv_id", "depth", "n_convs")
        .join(totals, list(_KEY))
        .join(below, list(_KEY), "left")
        .join(_ends(rows), list(_KEY), "left")
        .select(
            "conv_id",
            "depth",
            "parent_conv_id",
            "n_convs",
            F.col("children").alias("n_children"),
            F.col("leaves").alias("n_leaves"),
            F.col("saved").alias("saved_tokens"),
            F.coalesce("ends_sha256", F.lit(_NO_ENDS)).alias("ends_sha256"),
        )
    )


def rebuilt_trie(conversations: DataFrame, block: int = BLOCK) -> DataFrame:
    """The trie of ``conversations`` (conv_id, turn, role, text), each rebuilt on the head of another (see ``_rebuilt``).

    Turns of one number are ordered by role, then by the SHA-256 of role and text. Repeated rows are turns of their
    own, rows with a null conv_id belong to no conversation. Other columns are not read.
    """
    return prefix_trie(_rebuilt(conversations), block)


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rebuilt_trie(table(spark, sf_dir, "conversations"))


def _crc32_sql(value: str) -> str:
    """CRC-32 of a short ASCII string, bit by bit."""
    byte = "(lambda c, b: list_reduce(range(8), lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END, xor(c, b)))"
    codes = f"list_transform(string_split({value}, ''), lambda s: ascii(s)::BIGINT)"
    return f"xor(list_reduce({codes}, {byte[1:-1]}, 4294967295::BIGINT), 4294967295)"


OP12_SQL = f"""
WITH turns AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS p
    FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
    SELECT conv_id, list({{'role': role, 'text': text}} ORDER BY p) AS own FROM turns GROUP BY conv_id
), heads AS (
    SELECT conv_id, own, {_crc32_sql('conv_id::VARCHAR')} % 9 AS h FROM convs
), rebuilt AS (
    SELECT c.conv_id, list_concat(coalesce(b.own, [])[1:c.h], c.own[c.h + 1:]) AS turns
    FROM heads c LEFT JOIN convs b ON b.conv_id = c.conv_id - c.conv_id % 5
), prefixes AS (
    SELECT conv_id, len(turns) AS n, unnest(range(len(turns) + 1)) AS depth, turns FROM rebuilt
), nodes AS (
    SELECT turns[1:depth] AS key, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
           sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE n = depth), '')) AS ends_sha256
    FROM prefixes GROUP BY 1, 2
), weighed AS (
    SELECT *, (n_convs - 1) * coalesce(strlen(key[depth].text), 0) AS saved,
           (SELECT count(*) FROM nodes c WHERE c.depth = n.depth + 1 AND c.key[1:n.depth] = n.key) AS n_children
    FROM nodes n
), subtrees AS (
    SELECT a.key, a.depth, sum((v.n_children = 0)::BIGINT) AS n_leaves, sum(v.saved) AS saved_tokens
    FROM weighed a JOIN weighed v ON v.depth >= a.depth AND v.key[1:a.depth] = a.key GROUP BY 1, 2
)
SELECT n.conv_id, n.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs::BIGINT AS n_convs,
       n.n_children::BIGINT AS n_children, s.n_leaves::BIGINT AS n_leaves, s.saved_tokens::BIGINT AS saved_tokens,
       n.ends_sha256
FROM weighed n
JOIN subtrees s ON s.key = n.key AND s.depth = n.depth
LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.key = n.key[1:n.depth - 1]
"""
