"""Filter interaction audit: what each filter removes in every order of the filters, from counts of failure masks.

Each document becomes one mask, a bit for each filter that it fails. Counts by part and mask (at most 2^k rows a part) are the
only thing that is counted over documents. The subset-zeta transform, one pass a bit, turns a part's mask counts into sums
over all submasks; what a set S of filters leaves is the sum over the submasks of S's complement. A step of an order is then the
difference between the set before it and the set after it, for documents and for labels alike, and a filter's sum over all orders
weighs the same differences by how many orders pass through them.

The filter of exact copies is judged over the whole table by SHA-256 of the text: rows are pre-aggregated by it, and large groups
of copies are joined by broadcast.

Defined results: a null text counts as empty and a null part as the empty string; a copy fails if a smaller id has its text, so
a null id neither fails nor makes others fail and has no labels, and rows that repeat an id don't make each other fail; a document with several
labels counts as good, or toxic, if one of them says so, one without labels as neither; other columns are left out, so names can't
clash; no documents give no rows.
"""

from __future__ import annotations

import itertools
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlark.llm.common import Scratch, spread_join

#: Words are what white space separates.
GAP = r"[\x20\x09-\x0D]+"
#: Filters beyond which the orders are too many to list.
MOST_FILTERS = 7


def text_filters() -> dict[str, Column | None]:
    """Conditions on the column text under which a document fails; None stands for the filter of exact copies."""
    words = F.filter(F.split("text", GAP), lambda w: w != "")
    n, capitals = F.size(words), F.length(F.regexp_replace("text", "[^A-Z]+", ""))
    return {
        "A": n < 200,
        "B": 100 * F.size(F.array_distinct(words)) < 50 * n,
        "C": 100 * capitals > 3 * F.length("text"),
        "D": F.col("text").rlike("[#$%&*|]"),
        "E": None,
    }


def mask_counts(docs: DataFrame, labels: DataFrame, filters: dict[str, Column | None], id: str = "doc_id", part: str = "lang") -> DataFrame:
    """part, mask, n, good, toxic: documents of each failure mask, and how many of them are labelled so."""
    scratch = Scratch(docs.sparkSession, "filter-audit")
    bits = {letter: 1 << i for i, letter in enumerate(filters)}
    plain = docs.select(F.col(id).alias("id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), F.coalesce("text", F.lit("")).alias("text"))
    mask = sum((F.when(fails, bits[letter]).otherwise(0) for letter, fails in filters.items() if fails is not None), F.lit(0))
    rows = scratch.save(plain.select("id", "part", mask.alias("mask"), F.unhex(F.sha2("text", 256)).alias("digest")), "masks")
    copies = [bits[letter] for letter, fails in filters.items() if fails is None]
    if copies:
        groups = scratch.save(rows.groupBy("digest").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("size")).filter("size > 1"), "copies")
        told = spread_join(rows, groups, ["digest"], "size", rows.count(), "left")
        rows = scratch.save(told.select("id", "part", F.when(F.col("id") > F.col("first"), F.col("mask") + copies[0]).otherwise(F.col("mask")).alias("mask")), "told")
    said = labels.filter("doc_id is not null").groupBy(F.col("doc_id").alias("id")).agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    known = rows.filter("id is not null").join(said, "id", "left")
    every = known.unionByName(rows.filter("id is null"), allowMissingColumns=True)  # null ids would meet in one task
    return every.groupBy("part", "mask").agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("good"), F.lit(0)).cast("long").alias("good"), F.coalesce(F.sum("toxic"), F.lit(0)).cast("long").alias("toxic"))


def zeta(counts: Column, k: int) -> list:
    """The k passes of the subset-zeta transform over an array of 2^k structs(n, good, toxic): each bit adds the element without it."""
    def pass_of(bit: int):
        def step(array: Column) -> Column:
            def added(x: Column, at: Column) -> Column:
                other = F.get(array, at.bitwiseXOR(F.lit(bit)))
                return F.when(at.bitwiseAND(F.lit(bit)) != 0, F.struct(*((x[c] + other[c]).alias(c) for c in ("n", "good", "toxic")))).otherwise(x)

            return F.transform(array, added)

        return step

    return [pass_of(1 << i) for i in range(k)]


def step_counts(masks: DataFrame, letters: str) -> DataFrame:
    """Every order's steps, from mask counts of the filters in the order of letters."""
    if len(letters) > MOST_FILTERS:
        raise ValueError(f"{len(letters)} filters; at most {MOST_FILTERS}")
    k, whole = len(letters), (1 << len(letters)) - 1
    zero = F.struct(*(F.lit(0).cast("long").alias(c) for c in ("n", "good", "toxic")))
    held = masks.groupBy("part").agg(F.map_from_entries(F.collect_list(F.struct("mask", F.struct("n", "good", "toxic")))).alias("held"))  # 2^k entries at most
    sums = held.withColumn("counts", F.transform(F.sequence(F.lit(0), F.lit(whole)), lambda m: F.coalesce(F.get(F.array(F.col("held")[m]), F.lit(0)), zero)))
    sums = sums.withColumn("sums", F.col("counts"))
    for step in zeta(F.col("sums"), k):
        sums = sums.withColumn("sums", step(F.col("sums")))

    def left(filters: Column, column: str = "n") -> Column:
        """Documents that a set of filters leaves."""
        return F.get("sums", F.lit(whole) - filters)[column]

    weights = F.array(*(F.lit(math.factorial(s) * math.factorial(k - 1 - s)).cast("long") for s in range(k)))

    def over_orders(bit: Column) -> Column:
        """Sum over all orders of what the filter removes: sets without it, each as often as an order passes through it."""
        def added(acc: Column, s: Column) -> Column:
            return F.when(s.bitwiseAND(bit) != 0, acc).otherwise(acc + F.get(weights, F.bit_count(s).cast("int")) * (left(s) - left(s + bit)))

        return F.aggregate(F.sequence(F.lit(0), F.lit(whole)), F.lit(0).cast("long"), added)

    shares = F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: over_orders(F.call_function("shiftleft", F.lit(1), i)))
    orders = F.split(F.lit(" ".join(map("".join, itertools.permutations(letters)))), " ")
    listed = sums.select("part", "counts", "sums", shares.alias("shares"), F.explode(orders).alias("filter_order"))
    steps = listed.select("*", F.posexplode(F.filter(F.split("filter_order", ""), lambda c: c != "")).alias("at", "letter"))
    bit_of = lambda c: F.call_function("shiftleft", F.lit(1), F.instr(F.lit(letters), c) - 1)
    ahead = F.aggregate(F.sequence(F.lit(1), F.col("at") + 1), F.lit(0), lambda acc, i: F.when(i <= F.col("at"), acc + bit_of(F.substring(F.col("filter_order"), i, F.lit(1)))).otherwise(acc))
    steps = steps.withColumns({"i": F.instr(F.lit(letters), F.col("letter")) - 1, "before": ahead})
    steps = steps.withColumn("bit", F.call_function("shiftleft", F.lit(1), F.col("i"))).withColumn("after", F.col("before") + F.col("bit"))
    removed = {c: left(F.col("before"), c) - left(F.col("after"), c) for c in ("n", "good", "toxic")}
    return steps.select(
        "part",
        "filter_order",
        (F.col("at") + 1).cast("int").alias("step"),
        left(F.col("after")).alias("kept"),
        removed["n"].alias("removed"),
        (left(F.lit(0)) - left(F.col("bit")) - removed["n"]).alias("redundant"),
        F.get("counts", F.col("bit"))["n"].alias("unique_fails"),
        removed["good"].alias("good_lost"),
        removed["toxic"].alias("toxic_lost"),
        F.get("shares", F.col("i")).alias("shapley"),
    )


def audit(docs: DataFrame, labels: DataFrame, filters: dict[str, Column | None] | None = None, id: str = "doc_id", part: str = "lang") -> DataFrame:
    """part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley.

    filters: one-letter names and the conditions on the column text under which a document fails, None for exact copies.
    """
    filters = filters or text_filters()
    return step_counts(mask_counts(docs, labels, filters, id, part), "".join(filters))


ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
f AS (
  SELECT d.part, len(w) < 200 AS fa, 100 * len(list_distinct(w)) < 50 * len(w) AS fb, 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t) AS fc,
    regexp_matches(t, '[#$%&*|]') AS fd, coalesce(d.doc_id > min(d.doc_id) OVER (PARTITION BY t), false) AS fe, coalesce(l.good, 0) AS good, coalesce(l.toxic, 0) AS toxic
  FROM d LEFT JOIN l ON d.doc_id = l.doc_id),
m AS (
  SELECT part, CASE WHEN fa THEN 'A' ELSE '' END || CASE WHEN fb THEN 'B' ELSE '' END || CASE WHEN fc THEN 'C' ELSE '' END || CASE WHEN fd THEN 'D' ELSE '' END || CASE WHEN fe THEN 'E' ELSE '' END AS fails,
    count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY 1, 2),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c),
o AS (
  SELECT a.c || b.c || c.c || d.c || e.c AS filter_order FROM x a, x b, x c, x d, x e
  WHERE len(list_distinct([a.c, b.c, c.c, d.c, e.c])) = 5),
s AS (SELECT filter_order, step, substr(filter_order, step, 1) AS letter, substr(filter_order, 1, step - 1) AS ahead FROM o, (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
r AS (
  SELECT part, filter_order, step, letter,
    coalesce(sum(n) FILTER (WHERE translate(fails, ahead || letter, '') = fails), 0) AS kept,
    coalesce(sum(n) FILTER (WHERE contains(fails, letter) AND translate(fails, ahead, '') = fails), 0) AS removed,
    coalesce(sum(n) FILTER (WHERE contains(fails, letter) AND translate(fails, ahead, '') <> fails), 0) AS redundant,
    coalesce(sum(n) FILTER (WHERE fails = letter), 0) AS unique_fails,
    coalesce(sum(good) FILTER (WHERE contains(fails, letter) AND translate(fails, ahead, '') = fails), 0) AS good_lost,
    coalesce(sum(toxic) FILTER (WHERE contains(fails, letter) AND translate(fails, ahead, '') = fails), 0) AS toxic_lost
  FROM m, s GROUP BY 1, 2, 3, 4)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
  CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley FROM r
"""
