"""Conversation prefix trie, built level by level: conversations that begin alike share the nodes of their common turns.

A node is a distinct sequence of first turns, named by its depth and the smallest conversation that begins so. Level by level, the
conversations that still share a node are grouped by (node, next turn): each group is a child, under its smallest conversation.
A conversation that is alone in its node shares nothing deeper, so the rest of its path is a chain that needs no grouping; it
leaves the live ones. Then the levels are gone through in reverse, each joined with its children's sums: children, leaves, savings.
There is one round of small jobs for each depth at which two conversations still share a node.

Turns are compared by SHA-256 of role and text, so texts aren't shuffled again after the first pass. A common first turn is
pre-aggregated and joined by broadcast. Turns are numbered by their place in a range-sorted table, so one long conversation is
numbered by many tasks. Ends of a shared node are put together in blocks of at most 4,096 ids and streamed in order through one hash.

Defined results: rows with a null conv_id take no part; a null turn comes before all others; turns of equal number are ordered by role,
then text; a null role or text is empty; repeated rows are turns of their own; other columns are left out, so names can't clash; no
conversations give no nodes, not even a root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerlark.llm.common import Scratch, spread_join

#: Family and most turns that a conversation takes over from the first of its family, in rebuilt().
FAMILY, MOST_TAKEN = 5, 9
#: Ids in a block of ends: 2**BLOCK_BITS at most; levels of a chain in a block.
BLOCK_BITS, CHAIN = 12, 4096
NOTHING = hashlib.sha256(b"").hexdigest()


def numbered(conversations: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """(turns, runs): conv, part, at, key, bytes in order, and of each conversation's rows in a part: first, before (rows in parts ahead), n.

    A turn's index is before + at - first.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turns = conversations.filter(F.col("conv_id").isNotNull()).select(F.col("conv_id").cast("long").alias("conv"), "turn", role.alias("role"), text.alias("text"))
    order = [F.col("conv"), F.col("turn").asc_nulls_first()]
    dealt = turns.repartitionByRange(*order).sortWithinPartitions(*order, "role", "text")
    key = F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256))
    rows = scratch.save(dealt.select("conv", key.alias("key"), F.octet_length("text").cast("long").alias("bytes"), F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at")), "turns")
    runs = rows.groupBy("conv", "part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    ahead = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row a part
    return rows, scratch.save(runs.withColumn("before", F.coalesce(F.sum("n").over(ahead), F.lit(0))), "runs")


def rebuilt(conversations: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """(convs, turns): conv and length, and conv, depth (from 1), key, bytes, of conversations rebuilt within families of five.

    Conversation c takes the first h = crc32(c) % 9 turns of conversation c - c % 5, then its own turns after its first h.
    """
    rows, runs = numbered(conversations, scratch)
    own = runs.groupBy("conv").agg(F.sum("n").alias("n"))
    heads = own.select(F.col("conv").alias("base"), F.col("n").alias("n_base"))
    h = F.crc32(F.col("conv").cast("string").cast("binary")) % MOST_TAKEN
    plan = own.withColumns({"base": F.col("conv") - F.col("conv") % FAMILY, "h": h}).join(heads, "base", "left")
    plan = plan.withColumn("taken", F.least("h", F.coalesce("n_base", F.lit(0))))
    plan = scratch.save(plan.select("conv", "base", "h", "taken", (F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length")), "plan")
    places = runs.join(plan.select("conv", "h", "taken"), "conv").select("conv", "part", (F.col("before") - F.col("first")).alias("shift"), "h", "taken")
    indexed = scratch.save(rows.join(places, ["conv", "part"]).select("conv", (F.col("at") + F.col("shift")).alias("i"), "key", "bytes", "h", "taken"), "indexed")
    kept = indexed.filter("i >= h").select("conv", (F.col("taken") + F.col("i") - F.col("h") + 1).alias("depth"), "key", "bytes")
    takers = plan.filter("taken > 0").select(F.col("conv").alias("taker"), F.col("base").alias("conv"), F.col("taken").alias("most"))
    taken = indexed.filter(F.col("i") < MOST_TAKEN).join(takers, "conv").filter("i < most").select(F.col("taker").alias("conv"), (F.col("i") + 1).alias("depth"), "key", "bytes")
    # Sorted by depth, so that a level's scan skips the other depths.
    turns = scratch.save(kept.unionByName(taken).sortWithinPartitions("depth"), "rebuilt")
    scratch.drop("turns", "runs", "indexed")
    return plan.select("conv", "length"), turns


def hashed_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted blocks (depth, conv, block, ids) to the digest of each node's joined ids; what is held is one hash."""
    node, state, done = None, None, []
    for batch in batches:
        for depth, conv, ids in zip(*(batch.column(name).to_pylist() for name in ("depth", "conv", "ids")), strict=True):
            if (depth, conv) != node:
                if node:
                    done.append((*node, state.hexdigest()))
                node, state = (depth, conv), hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        yield pa.RecordBatch.from_pylist([dict(zip(("depth", "conv", "ends_sha256"), d, strict=True)) for d in done], schema=ENDS)
        done = []
    if node:
        yield pa.RecordBatch.from_pylist([{"depth": node[0], "conv": node[1], "ends_sha256": state.hexdigest()}], schema=ENDS)


ENDS = pa.schema([("depth", pa.int64()), ("conv", pa.int64()), ("ends_sha256", pa.string())])


def trie(convs: DataFrame, turns: DataFrame, scratch: Scratch) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 of each node.

    convs: conv, length. turns: conv, depth (1 to length), key, bytes; written tables.
    """
    total, root = convs.agg(F.count(F.lit(1)), F.min("conv")).first()
    zero = F.lit(0).cast("long")
    levels = [convs.agg(F.min("conv").alias("conv"), F.lit(None).cast("long").alias("parent"), F.count(F.lit(1)).alias("n"), zero.alias("bytes"), F.max("length").alias("length")).filter("n > 0")]
    live = convs.select("conv", "length", F.lit(root).cast("long").alias("node"))
    empty, depth = live.filter("length = 0").select(zero.alias("depth"), F.col("node").alias("conv"), F.col("conv").alias("member")), 0
    while True:
        depth += 1
        next_turns = turns.filter(F.col("depth") == depth).select("conv", "key", "bytes")
        step = scratch.save(live.filter(F.col("length") >= depth).join(next_turns, "conv"), f"step-{depth}")
        grouped = step.groupBy("node", "key").agg(F.min("conv").alias("child"), F.count(F.lit(1)).alias("n"), F.max("bytes").alias("bytes"), F.max("length").alias("length"))
        groups = scratch.save(grouped, f"groups/depth={depth}")
        levels.append(groups.select(F.col("child").alias("conv"), F.col("node").alias("parent"), "n", "bytes", "length"))
        shared = groups.filter("n > 1").select("node", "key", "child", "n")
        if shared.isEmpty():
            break
        live = scratch.save(spread_join(step, shared, ["node", "key"], "n", total).select("conv", "length", F.col("child").alias("node")), f"live/depth={depth}")
        scratch.drop(f"step-{depth}")

    # In reverse: each shared level with the sums of its children.
    rolled = None
    for d in range(len(levels) - 1, -1, -1):
        shared = levels[d].filter("n > 1") if d else levels[d]
        if rolled is not None:
            sums = rolled.groupBy("parent").agg(F.count(F.lit(1)).alias("n_children"), F.sum("n_leaves").alias("leaves"), F.sum("saved").alias("saved_below"))
            shared = shared.join(sums.withColumnRenamed("parent", "__p"), F.col("conv") == F.col("__p"), "left")
        else:
            shared = shared.select("*", F.lit(None).cast("long").alias("n_children"), F.lit(None).cast("long").alias("leaves"), F.lit(None).cast("long").alias("saved_below"))
        told = shared.select("conv", "parent", "n", F.coalesce("n_children", zero).alias("n_children"), F.coalesce("leaves", zero + 1).alias("n_leaves"), ((F.col("n") - 1) * F.col("bytes") + F.coalesce("saved_below", zero)).alias("saved"))
        told = scratch.save(told, f"rolled/depth={d}")
        rolled = told.select("parent", "n_leaves", "saved")
        if d:
            rolled = rolled.unionByName(levels[d].filter("n = 1").select("parent", (zero + 1).alias("n_leaves"), zero.alias("saved")))

    # All levels are one table each: a plan that doesn't grow with the depth, and nothing joined again.
    every_end = empty if depth == 1 else empty.unionByName(scratch.levels("live", live).filter("length = depth").select("depth", F.col("node").alias("conv"), F.col("conv").alias("member")))
    blocks = every_end.groupBy("depth", "conv", F.shiftright("member", BLOCK_BITS).alias("block")).agg(F.array_join(F.transform(F.array_sort(F.collect_list("member")), lambda m: m.cast("string")), ",").alias("ids"))
    sorted_blocks = blocks.repartition("depth", "conv").sortWithinPartitions("depth", "conv", "block").select("depth", "conv", "ids")
    digests = sorted_blocks.mapInArrow(hashed_ends, "depth long, conv long, ends_sha256 string")
    several = scratch.levels("rolled", told).select("conv", "depth", "parent", "n", "n_children", "n_leaves", "saved").join(digests, ["depth", "conv"], "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(NOTHING)))

    # Chains of conversations that are alone from some depth on.
    alone = scratch.levels("groups", groups).filter("n = 1").select(F.col("child").alias("conv"), F.col("depth").alias("start"), F.col("node").alias("parent"), "length")
    first = F.col("start") + F.col("block") * CHAIN
    blocks = alone.select("*", F.explode(F.sequence(zero, F.floor((F.col("length") - F.col("start")) / CHAIN))).alias("block"))
    chain = blocks.repartition("conv", "block").select("*", F.explode(F.sequence(first, F.least(first + (CHAIN - 1), F.col("length")))).alias("depth"))
    last = F.col("depth") == F.col("length")
    single = chain.select(
        "depth",
        "conv",
        F.when(F.col("depth") == F.col("start"), F.col("parent")).otherwise(F.col("conv")).alias("parent"),
        (zero + 1).alias("n"),
        (~last).cast("long").alias("n_children"),
        (zero + 1).alias("n_leaves"),
        zero.alias("saved"),
        F.when(last, F.sha2(F.col("conv").cast("string"), 256)).otherwise(F.lit(NOTHING)).alias("ends_sha256"),
    )
    return several.unionByName(single).select(F.col("conv").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), F.col("n").alias("n_convs"), "n_children", "n_leaves", F.col("saved").alias("saved_tokens"), "ends_sha256")


def build(conversations: DataFrame) -> DataFrame:
    """The trie of the rebuilt conversations."""
    scratch = Scratch(conversations.sparkSession, "prefix-trie")
    return trie(*rebuilt(conversations, scratch), scratch)


ORACLE_SQL = r"""
WITH RECURSIVE t AS (
  SELECT conv_id AS conv, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS key, octet_length(encode(coalesce(text, ''))) AS bytes,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS i FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv, count(*) AS n, conv - conv % 5 AS base FROM t GROUP BY conv),
walk AS (
  SELECT conv, 0 AS step, CAST(4294967295 AS BIGINT) AS crc FROM c
  UNION ALL
  SELECT conv, step + 1, CASE WHEN step % 9 = 0 THEN xor(crc, ascii(substr(CAST(conv AS VARCHAR), step // 9 + 1, 1))) WHEN crc % 2 = 1 THEN xor(crc >> 1, 3988292384) ELSE crc >> 1 END
  FROM walk WHERE step < 9 * length(CAST(conv AS VARCHAR))),
bits AS (SELECT conv, xor(crc, 4294967295) % 9 AS h FROM walk WHERE step = 9 * length(CAST(conv AS VARCHAR))),
p AS (SELECT c.conv, c.base, h, least(h, coalesce(b.n, 0)) AS taken, least(h, coalesce(b.n, 0)) + greatest(c.n - h, 0) AS len FROM c JOIN bits ON c.conv = bits.conv LEFT JOIN c b ON b.conv = c.base),
r AS (
  SELECT p.conv, i + 1 AS depth, key, bytes FROM p JOIN t ON t.conv = p.base AND i < taken
  UNION ALL SELECT p.conv, taken + i - h + 1, key, bytes FROM p JOIN t ON t.conv = p.conv AND i >= h),
path AS (
  SELECT conv, depth, bytes, string_agg(key, '') OVER (PARTITION BY conv ORDER BY depth ROWS UNBOUNDED PRECEDING) AS prefix FROM r
  UNION ALL SELECT conv, 0, 0, '' FROM p),
node AS (SELECT depth, prefix, min(conv) AS conv_id, count(*) AS n_convs, (count(*) - 1) * max(bytes) AS saved FROM path GROUP BY depth, prefix),
named AS (SELECT path.conv, path.depth, conv_id, n_convs, saved FROM path JOIN node ON path.depth = node.depth AND path.prefix = node.prefix),
kid AS (SELECT DISTINCT a.depth, a.conv_id, b.conv_id AS kid FROM named a JOIN named b ON a.conv = b.conv AND b.depth = a.depth + 1),
kids AS (SELECT depth, conv_id, count(*) AS n_children FROM kid GROUP BY depth, conv_id),
below AS (
  SELECT a.depth, a.conv_id, sum(b.saved) AS saved_tokens, count(*) FILTER (WHERE k.n_children IS NULL) AS n_leaves
  FROM (SELECT DISTINCT depth, conv_id, saved FROM named) b JOIN named a ON a.conv = b.conv_id AND a.depth <= b.depth LEFT JOIN kids k ON k.depth = b.depth AND k.conv_id = b.conv_id
  GROUP BY a.depth, a.conv_id),
ends AS (SELECT named.depth, conv_id, sha256(string_agg(CAST(named.conv AS VARCHAR), ',' ORDER BY named.conv)) AS ends_sha256 FROM named JOIN p ON p.conv = named.conv AND p.len = named.depth GROUP BY named.depth, conv_id)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, up.conv_id AS parent_conv_id, n.n_convs, coalesce(k.n_children, 0) AS n_children, b.n_leaves, CAST(b.saved_tokens AS BIGINT) AS saved_tokens,
  coalesce(e.ends_sha256, sha256('')) AS ends_sha256
FROM node n JOIN below b ON b.depth = n.depth AND b.conv_id = n.conv_id LEFT JOIN kids k ON k.depth = n.depth AND k.conv_id = n.conv_id
LEFT JOIN named up ON up.conv = n.conv_id AND up.depth = n.depth - 1 LEFT JOIN ends e ON e.depth = n.depth AND e.conv_id = n.conv_id
"""
