"""Registered queries over the operators, each with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerlark.functions import text, values
from ledgerlark.operators import match, pick, report, upsert, validate
from ledgerlark.plans.shared import shared_folder
from ledgerlark.sources import markup
from ledgerlark.streaming import microbatch

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def registered(name: str, sql: str | None = None):
    """Register a query under a name, with its oracle where there is one."""

    def keep(query):
        QUERIES[name] = query
        if sql:
            ORACLES[name] = sql
        return query

    return keep


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@registered(
    "latest_per_key",
    """SELECT c_custkey, n_name, o_orderkey, o_orderdate, o_totalprice FROM (
         SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) o
       JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey WHERE rn = 1""",
)
def latest_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest row of each key with a total order (DQ1, WN4)."""
    orders = read(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    newest = Window.partitionBy("o_custkey").orderBy(F.desc("o_orderdate"), F.desc("o_orderkey"))
    latest = orders.withColumn("rn", F.row_number().over(newest)).filter("rn = 1").drop("rn")
    customers = read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nations = read(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return (
        latest.join(customers, latest.o_custkey == customers.c_custkey)
        .join(nations, customers.c_nationkey == nations.n_nationkey)
        .select("c_custkey", "n_name", "o_orderkey", "o_orderdate", "o_totalprice")
    )


# ---- writes -------------------------------------------------------------------------------------------

def _snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as snapshots: item, grade (null for one priority), day, price."""
    return read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("item"), F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("grade"), F.to_date("o_orderdate").alias("day"), F.col("o_totalprice").cast("decimal(14,2)").alias("price"), F.col("o_orderkey").alias("src"))


SNAPSHOT_SQL = "s AS (SELECT o_custkey AS item, nullif(o_orderpriority, '5-LOW') AS grade, CAST(o_orderdate AS DATE) AS day, CAST(o_totalprice AS DECIMAL(14,2)) AS price, o_orderkey AS src FROM orders)"


@registered(
    "idempotent_append",
    f"""WITH {SNAPSHOT_SQL}, cur AS (SELECT * FROM s WHERE price < 300000),
    b AS (SELECT *, row_number() OVER (PARTITION BY item, grade, day ORDER BY price, src) AS rn FROM s),
    new AS (SELECT b.item FROM b WHERE rn = 1 AND NOT EXISTS (SELECT 1 FROM cur WHERE cur.item = b.item AND cur.day = b.day AND cur.grade IS NOT DISTINCT FROM b.grade))
    SELECT item, count(*) AS inserted FROM new GROUP BY item""",
)
def idempotent_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New snapshots by item: one row a key of the batch, null grades equal (SK2, AG5)."""
    rows = _snapshots(spark, sf_dir)
    _, outcome = upsert.append_new(rows.filter("price < 300000"), rows, ["item", "grade", "day"], [F.col("price"), F.col("src")], "item")
    return outcome


@registered("append_replay_noop", "SELECT CAST(o_custkey AS BIGINT) AS item, CAST(0 AS BIGINT) AS inserted FROM orders WHERE 1 = 0")
def append_replay_noop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same batch a second time appends nothing (ST4)."""
    rows, keys, order = _snapshots(spark, sf_dir), ["item", "grade", "day"], [F.col("price"), F.col("src")]
    once, _ = upsert.append_new(rows.filter("price < 300000"), rows, keys, order, "item")
    return upsert.append_new(once, rows, keys, order, "item")[1]


@registered(
    "correction_window",
    """WITH m AS (SELECT max(CAST(ts AS DATE)) AS today FROM events)
    SELECT event_id, value AS old, value + 1 AS new FROM events, m
    WHERE CAST(ts AS DATE) >= today - 6 AND event_type IN ('view', 'purchase') AND hour(ts) < 12""",
)
def correction_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the last 7 days that are ours take the batch's value (SK3, ST2)."""
    events = read(spark, sf_dir, "events").select("event_id", "ts", "event_type", "value")
    today = events.agg(F.to_date(F.max("ts"))).first()[0]
    batch = events.filter("event_type in ('view', 'purchase')").select("event_id", (F.col("value") + 1).alias("value"))
    recent = F.to_date("ts") >= values.window_start(F.lit(today), 7)
    return upsert.correct_recent(events, batch, ["event_id"], ["value"], "value", recent, F.hour("ts") < 12)[1]


@registered(
    "upsert_outcome",
    """WITH cur AS (SELECT p_partkey, p_retailprice FROM part WHERE p_size <= 40),
    b AS (SELECT p_partkey, CASE WHEN p_size < 20 THEN p_retailprice + 1 ELSE p_retailprice END AS p_retailprice FROM part)
    SELECT CASE WHEN cur.p_partkey IS NULL THEN 'inserted' WHEN cur.p_retailprice IS DISTINCT FROM b.p_retailprice THEN 'updated' ELSE 'unchanged' END AS outcome, count(*) AS n
    FROM b LEFT JOIN cur ON b.p_partkey = cur.p_partkey GROUP BY 1""",
)
def upsert_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    """inserted, updated, unchanged from one full join (SK5)."""
    part = read(spark, sf_dir, "part").select("p_partkey", "p_retailprice", "p_size")
    batch = part.withColumn("p_retailprice", F.when(F.col("p_size") < 20, F.col("p_retailprice") + 1).otherwise(F.col("p_retailprice")))
    _, outcome = upsert.upsert(part.filter("p_size <= 40"), batch, ["p_partkey"], ["p_retailprice"])
    return outcome.groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


@registered(
    "column_diff",
    """SELECT c_custkey, 'c_name' AS col, c_name AS old, upper(c_name) || '!' AS new FROM customer WHERE c_custkey % 4 <> 1
    UNION ALL SELECT c_custkey, 'c_mktsegment', c_mktsegment, 'NONE' FROM customer WHERE c_custkey % 4 IN (0, 1) AND c_custkey % 3 <> 0""",
)
def column_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change log of a column-wise upsert with absent and protected columns (SK6)."""
    customer = read(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    k = F.col("c_custkey")
    current = customer.withColumn("protected", F.when(k % 3 == 0, F.array(F.lit("c_mktsegment"))).otherwise(F.array().cast("array<string>")))
    present = F.when(k % 4 == 0, F.array(F.lit("c_name"), F.lit("c_mktsegment"))).when(k % 4 == 1, F.array(F.lit("c_mktsegment"))).otherwise(F.array(F.lit("c_name")))
    intended = customer.select("c_custkey", F.concat(F.upper("c_name"), F.lit("!")).alias("c_name"), F.lit("NONE").alias("c_mktsegment"), present.alias("present"))
    return upsert.diff_rows(current, intended, "c_custkey", ["c_name", "c_mktsegment"], "present", "protected")[1]


@registered("scoped_delete", "SELECT l_orderkey, count(*) AS removed FROM lineitem WHERE l_returnflag = 'R' AND l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F') GROUP BY l_orderkey")
def scoped_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows deleted for this run's keys alone (SK4)."""
    lines, loaded = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_returnflag"), read(spark, sf_dir, "orders").filter("o_orderstatus = 'F'")
    return upsert.scoped_delete(lines, F.col("l_returnflag") == "R", loaded.withColumnRenamed("o_orderkey", "l_orderkey"), "l_orderkey")[1]


@registered(
    "replace_group",
    """WITH b AS (SELECT l_orderkey, l_returnflag, max(l_quantity) AS l_quantity FROM lineitem GROUP BY l_orderkey, l_returnflag),
    c AS (SELECT l_orderkey, l_returnflag, count(*) AS n, min(l_quantity) AS q FROM lineitem WHERE l_linestatus = 'F' GROUP BY l_orderkey, l_returnflag)
    SELECT CASE WHEN coalesce(c.n, 0) = 1 AND c.q = b.l_quantity THEN 'unchanged' ELSE 'replaced' END AS outcome, count(*) AS n
    FROM b LEFT JOIN c ON b.l_orderkey = c.l_orderkey AND b.l_returnflag = c.l_returnflag GROUP BY 1""",
)
def replace_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups replaced, or left where the one row is equal (SK9)."""
    lines = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_returnflag", "l_quantity", "l_linestatus")
    batch = lines.groupBy("l_orderkey", "l_returnflag").agg(F.max("l_quantity").alias("l_quantity"))
    _, status = upsert.replace_groups(lines, batch, ["l_orderkey", "l_returnflag"], F.col("l_linestatus") == "F", ["l_quantity"])
    return status.groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


@registered(
    "get_or_create_dim",
    """WITH d AS (SELECT p_brand, p_type, row_number() OVER (ORDER BY p_brand, p_type) AS id FROM (SELECT DISTINCT p_brand, p_type FROM part WHERE p_size <= 10)),
    n AS (SELECT DISTINCT p_brand, p_type FROM part EXCEPT SELECT p_brand, p_type FROM d)
    SELECT p_brand, p_type, CAST(id AS BIGINT) AS id FROM d UNION ALL
    SELECT p_brand, p_type, CAST((SELECT coalesce(max(id), 0) FROM d) + row_number() OVER (ORDER BY p_brand, p_type) AS BIGINT) FROM n""",
)
def get_or_create_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dimension with new keys under the next ids (SK10)."""
    part, keys = read(spark, sf_dir, "part"), ["p_brand", "p_type"]
    empty = part.select(*keys, F.lit(0).cast("long").alias("id")).limit(0)
    return upsert.get_or_create(upsert.get_or_create(empty, part.filter("p_size <= 10"), keys, "id"), part, keys, "id")


# ---- validation ---------------------------------------------------------------------------------------

LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity"]


@registered(
    "strictly_increasing",
    """WITH x AS (SELECT l_orderkey, l_shipdate, lag(l_shipdate) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity) AS p FROM lineitem)
    SELECT l_orderkey, count(*) AS n FROM x GROUP BY l_orderkey HAVING NOT coalesce(bool_or(l_shipdate <= p), false)""",
)
def strictly_increasing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups whose dates rise at each step; others are rejected whole (WN1)."""
    lines = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_shipdate", *LINE_ORDER)
    good, _ = validate.strictly_increasing(lines, ["l_orderkey"], [F.col(c) for c in LINE_ORDER], "l_shipdate")
    return good.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"))


@registered(
    "first_failure",
    """WITH x AS (SELECT user_id, event_id, CASE WHEN event_type = 'error' THEN 'type' WHEN value > 90 THEN 'range' WHEN event_id % 17 = 0 THEN 'id' END AS reason FROM events),
    f AS (SELECT user_id, reason, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn FROM x WHERE reason IS NOT NULL)
    SELECT u.user_id, f.reason FROM (SELECT DISTINCT user_id FROM events) u LEFT JOIN f ON u.user_id = f.user_id AND f.rn = 1""",
)
def first_failure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first rule that a group's first failing row breaks (WN2)."""
    rules = [("type", F.col("event_type") == "error"), ("range", F.col("value") > 90), ("id", F.col("event_id") % 17 == 0)]
    return validate.first_failure(read(spark, sf_dir, "events"), ["user_id"], ["event_id"], rules)


@registered(
    "membership_split",
    """WITH l AS (SELECT doc_id FROM labels), d AS (SELECT conv_id AS doc_id FROM conversations)
    SELECT 'kept' AS part, count(*) AS n FROM d WHERE doc_id IN (SELECT doc_id FROM l) UNION ALL
    SELECT 'extra', count(*) FROM d WHERE doc_id NOT IN (SELECT doc_id FROM l) UNION ALL
    SELECT 'missing', count(*) FROM l WHERE doc_id NOT IN (SELECT doc_id FROM d)""",
)
def membership_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns whose conversation's id is labelled, those that are extra, and labels that are missing (FL3, SE1)."""
    docs = read(spark, sf_dir, "conversations").select(F.col("conv_id").alias("doc_id"))
    parts = zip(("kept", "extra", "missing"), validate.membership(docs, read(spark, sf_dir, "labels").select("doc_id"), "doc_id"), strict=True)
    out = [p.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("part"), "n") for name, p in parts]
    return out[0].unionByName(out[1]).unionByName(out[2])


# ---- matching -----------------------------------------------------------------------------------------


def _cards(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Parts as cards and as rows: brand as packaging, size as year, type as value, name as title."""
    part = read(spark, sf_dir, "part").select("p_partkey", F.col("p_size").alias("year"), F.col("p_type").alias("value"), F.col("p_brand").alias("pack"), F.col("p_name").alias("title"))
    return part.filter("p_partkey % 2 = 0").withColumnRenamed("p_partkey", "card"), part.filter("p_partkey % 2 = 1").withColumnRenamed("p_partkey", "row")


MATCH_SQL = """c AS (SELECT p_partkey AS card, p_size AS y, p_type AS v, p_brand AS k, p_name AS t FROM part WHERE p_partkey % 2 = 0),
    r AS (SELECT p_partkey AS r_key, p_size AS y, p_type AS v, p_brand AS k, p_name AS t FROM part WHERE p_partkey % 2 = 1),
    e AS (SELECT card, r_key, c.t = r.t AS exact, false AS banded FROM c JOIN r ON c.y = r.y AND c.v = r.v AND c.k = r.k AND (c.t = r.t OR starts_with(c.t, r.t || ' ') OR starts_with(r.t, c.t || ' '))),
    b AS (SELECT card, r_key, c.t = r.t AS exact, true AS banded FROM c JOIN r ON (c.y = r.y - 1 OR c.y = r.y + 1) AND c.v = r.v AND c.k = r.k AND (c.t = r.t OR starts_with(c.t, r.t || ' ') OR starts_with(r.t, c.t || ' '))
          WHERE card NOT IN (SELECT card FROM e)),
    f AS (SELECT * FROM e UNION ALL SELECT * FROM b),
    g AS (SELECT card, r_key FROM (SELECT *, count(*) FILTER (WHERE exact) OVER (PARTITION BY card) AS n FROM f) WHERE n <> 1 OR exact),
    p AS (SELECT card, count(DISTINCT r_key) AS n, min(r_key) AS r_key FROM g GROUP BY card),
    w AS (SELECT r_key FROM p WHERE n = 1 GROUP BY r_key HAVING count(*) > 1)"""


@registered("candidate_match", f'WITH {MATCH_SQL} SELECT card, r_key AS "row", exact, banded FROM f')
def candidate_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates by equality keys and title, with the band's fallback (JN3, JN4)."""
    return match.with_fallback(*_cards(spark, sf_dir))


@registered(
    "contested_claims",
    f"""WITH {MATCH_SQL} SELECT c.card, CASE WHEN p.card IS NULL THEN 'unmatched' WHEN p.n > 1 THEN 'ambiguous' WHEN w.r_key IS NOT NULL THEN 'contested' ELSE 'matched' END AS status,
    CASE WHEN p.n = 1 AND w.r_key IS NULL THEN p.r_key END AS "row" FROM c LEFT JOIN p ON c.card = p.card LEFT JOIN w ON p.n = 1 AND p.r_key = w.r_key""",
)
def contested_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole match with its conflicts (JN3-JN7)."""
    return match.match(*_cards(spark, sf_dir)).select("card", "status", "row")


@registered(
    "band_fallback",
    """WITH c AS (SELECT c_custkey, c_nationkey FROM customer), o AS (SELECT DISTINCT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS y FROM orders),
    e AS (SELECT c_custkey FROM c JOIN o ON c_custkey = o_custkey AND y = 1998)
    SELECT c_custkey, y FROM c JOIN o ON c_custkey = o_custkey AND (y = 1997 OR y = 1999) WHERE c_custkey NOT IN (SELECT c_custkey FROM e)""",
)
def band_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Neighbouring years for customers without an order in the year itself: customers as cards of 1998, their years as rows (JN4)."""
    same = [F.lit(None).cast("string").alias("pack"), F.lit("").alias("title")]
    years = read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("value"), F.year("o_orderdate").alias("year")).distinct()
    rows = years.select(F.struct("value", "year").alias("row"), "value", "year", *same)
    customers = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("card"), F.col("c_custkey").alias("value"), F.lit(1998).alias("year"), *same)
    return match.with_fallback(customers, rows).filter("banded").select(F.col("card").alias("c_custkey"), F.col("row.year").alias("y"))


@registered(
    "preferred_pick",
    """SELECT o_orderkey, l_shipdate, l_linenumber FROM (SELECT o_orderkey, l_shipdate, l_linenumber, row_number() OVER (PARTITION BY o_orderkey
       ORDER BY CASE WHEN year(l_shipdate) = year(o_orderdate) THEN 0 ELSE 1 END, l_shipdate, l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS rn
       FROM orders JOIN lineitem ON o_orderkey = l_orderkey) WHERE rn = 1""",
)
def preferred_pick(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same year's earliest row, else the earliest (JN9)."""
    lines = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_shipdate", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    joined = read(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate").join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
    order = [F.col(c) for c in ("l_shipdate", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")]
    return pick.preferred(joined, ["o_orderkey"], F.year("l_shipdate") == F.year("o_orderdate"), order).select("o_orderkey", "l_shipdate", "l_linenumber")


@registered(
    "shared_index",
    """WITH x AS (SELECT DISTINCT p_name AS id, p_brand AS card FROM part), n AS (SELECT id, count(*) AS n FROM x GROUP BY id)
    SELECT x.id, x.card FROM x JOIN n ON x.id = n.id WHERE n.n = 1 OR x.id LIKE '%a%'""",
)
def shared_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of several cards only where declared (JN10)."""
    refs = read(spark, sf_dir, "part").select(F.col("p_name").alias("id"), F.col("p_brand").alias("card"))
    return match.shared_index(refs, refs.filter("id like '%a%'").select("id").distinct())


@registered(
    "outer_merge_sides",
    """SELECT CASE WHEN l.doc_id IS NULL THEN 'left' WHEN d.doc_id IS NULL THEN 'right' ELSE 'both' END AS side, count(*) AS n
    FROM (SELECT DISTINCT conv_id AS doc_id FROM conversations) d FULL JOIN labels l ON d.doc_id = l.doc_id GROUP BY 1""",
)
def outer_merge_sides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both, left and right keys (JN1)."""
    docs = read(spark, sf_dir, "conversations").select(F.col("conv_id").alias("doc_id"))
    return match.outer_sides(docs, read(spark, sf_dir, "labels"), "doc_id").groupBy("side").agg(F.count(F.lit(1)).alias("n"))


@registered("carry_forward", "SELECT d.doc_id, d.lang, l.quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id")
def carry_forward(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Earlier values or null (JN2)."""
    return match.carry_forward(read(spark, sf_dir, "documents").select("doc_id", "lang"), read(spark, sf_dir, "labels"), "doc_id", ["quality"])


@registered(
    "twin_self_join",
    """WITH b AS (SELECT p_size, p_retailprice, min(p_partkey) AS twin FROM part WHERE p_partkey % 3 <> 0 GROUP BY p_size, p_retailprice)
    SELECT p_partkey AS card, twin FROM part JOIN b ON part.p_size = b.p_size AND part.p_retailprice = b.p_retailprice WHERE p_partkey % 3 = 0""",
)
def twin_self_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each tailed row's first bare twin (JN13)."""
    part = read(spark, sf_dir, "part").select("p_partkey", "p_size", "p_retailprice")
    return match.twins(part, ["p_size", "p_retailprice"], F.col("p_partkey") % 3 == 0, "p_partkey")


GROUPS_SQL = """l AS (SELECT DISTINCT c_mktsegment AS a, c_nationkey AS m FROM customer), r AS (SELECT DISTINCT CAST(floor(s_acctbal / 1000) AS BIGINT) AS b, s_nationkey AS m FROM supplier)"""


def _overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = read(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("a"), F.col("c_nationkey").alias("member")).distinct()
    right = read(spark, sf_dir, "supplier").select(F.floor(F.col("s_acctbal") / 1000).alias("b"), F.col("s_nationkey").alias("member")).distinct()
    return match.overlaps(left, right)


@registered("overlap_scores", f"WITH {GROUPS_SQL} SELECT a, b, count(*) AS overlap FROM l JOIN r ON l.m = r.m GROUP BY a, b")
def overlap_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Members that two groups share (JN15, AG11)."""
    return _overlaps(spark, sf_dir)


@registered(
    "overlap_pairs",
    f"""WITH RECURSIVE {GROUPS_SQL}, s AS (SELECT a, b, count(*) AS overlap FROM l JOIN r ON l.m = r.m GROUP BY a, b), o AS (SELECT *, row_number() OVER (ORDER BY overlap DESC, a, b) AS i FROM s),
    g AS (SELECT CAST(0 AS BIGINT) AS i, CAST([] AS VARCHAR[]) AS ua, CAST([] AS BIGINT[]) AS ub, CAST(NULL AS VARCHAR) AS a, CAST(NULL AS BIGINT) AS b, CAST(NULL AS BIGINT) AS overlap
          UNION ALL SELECT o.i, CASE WHEN free THEN list_append(ua, o.a) ELSE ua END, CASE WHEN free THEN list_append(ub, o.b) ELSE ub END, CASE WHEN free THEN o.a END, CASE WHEN free THEN o.b END, CASE WHEN free THEN o.overlap END
          FROM (SELECT o.*, ua, ub, NOT list_contains(ua, o.a) AND NOT list_contains(ub, o.b) AS free FROM g JOIN o ON o.i = g.i + 1) o)
    SELECT a, b, overlap FROM g WHERE a IS NOT NULL""",
)
def overlap_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Greedy one-to-one pairs by overlap (JN15, SO4)."""
    root = shared_folder(spark, "pairs")

    def save(df: DataFrame, step: int) -> DataFrame:
        df.write.parquet(f"{root}/{step}")
        return spark.read.parquet(f"{root}/{step}")

    return match.greedy_pairs(_overlaps(spark, sf_dir), save)


@registered(
    "reference_guard",
    """SELECT s_suppkey, n_name, r_name FROM supplier JOIN (SELECT * FROM nation WHERE n_regionkey <> 3) ON s_nationkey = n_nationkey
    LEFT JOIN (SELECT * FROM region WHERE r_regionkey <> 2) ON n_regionkey = r_regionkey""",
)
def reference_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A required reference rejects the row, an optional one leaves null (JN18)."""
    nations, regions = read(spark, sf_dir, "nation").filter("n_regionkey <> 3"), read(spark, sf_dir, "region").filter("r_regionkey <> 2")
    good, _ = match.resolve(read(spark, sf_dir, "supplier"), nations, "s_nationkey", "n_nationkey", ["n_name", "n_regionkey"], True)
    return match.resolve(good, regions, "n_regionkey", "r_regionkey", ["r_name"], False)[0].select("s_suppkey", "n_name", "r_name")


@registered(
    "anti_on_normalised",
    """SELECT p_partkey, p_name FROM part WHERE lower(trim(regexp_replace(p_name, '\\s+', ' ', 'g'))) NOT IN
       (SELECT lower(trim(regexp_replace(p_name, '\\s+', ' ', 'g'))) FROM part WHERE p_size > 49)""",
)
def anti_on_normalised(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles that no known title equals after normalisation (JN19)."""
    part = read(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size")
    return match.unknown_titles(part.drop("p_size"), "p_name", part.filter("p_size > 49"), ["p_name"], text.match_key)


@registered(
    "merge_states",
    """WITH f AS (SELECT DISTINCT conv_id AS k FROM conversations), e AS (SELECT doc_id AS k, quality = 1 AS curated FROM labels)
    SELECT coalesce(f.k, e.k) AS id, CASE WHEN e.k IS NULL THEN 'added' WHEN f.k IS NOT NULL AND curated THEN 'conflict' WHEN f.k IS NULL AND NOT curated THEN 'vanished' ELSE 'kept' END AS state FROM f FULL JOIN e ON f.k = e.k""",
)
def merge_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled ids, some of them curated, merged with the conversations' ids (JN16)."""
    existing = read(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"), (F.col("quality") == 1).alias("curated"))
    return match.merge_dictionary(read(spark, sf_dir, "conversations").select(F.col("conv_id").alias("id")), existing, "id")


# ---- accounting ---------------------------------------------------------------------------------------


@registered("status_rollup", "SELECT o_orderpriority, count(*) AS total, count(*) FILTER (WHERE o_orderstatus = 'F') AS \"F\", count(*) FILTER (WHERE o_orderstatus = 'O') AS \"O\", count(*) FILTER (WHERE o_orderstatus = 'P') AS \"P\" FROM orders GROUP BY o_orderpriority")
def status_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts by status (AG1)."""
    return report.status_counts(read(spark, sf_dir, "orders"), "o_orderstatus", ["F", "O", "P"], ["o_orderpriority"])


@registered("run_verdict", "SELECT o_custkey, CASE WHEN bool_and(o_totalprice > 50000) THEN 'ok' WHEN bool_or(o_totalprice > 50000) THEN 'partial' ELSE 'failed' END AS verdict FROM orders GROUP BY o_custkey")
def run_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ok, partial or failed by key (AG2)."""
    return report.run_verdict(read(spark, sf_dir, "orders"), F.col("o_totalprice") > 50000, ["o_custkey"])


@registered("series_stats", "SELECT user_id, count(*) AS points, min(ts) AS first_ts, max(ts) AS last_ts, min(value) AS low, max(value) AS high FROM events GROUP BY user_id")
def series_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Count, span and range of each series (AG3)."""
    return report.series_stats(read(spark, sf_dir, "events"), ["user_id"], "ts", "value")


@registered("series_members", "SELECT p_brand, count(DISTINCT l_orderkey) AS n_cards, min(year(l_shipdate)) AS first_year, max(year(l_shipdate)) AS last_year FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1")
def series_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders and years of each brand (AG4)."""
    lines = read(spark, sf_dir, "lineitem").select("l_partkey", "l_orderkey", F.year("l_shipdate").cast("long").alias("year"))
    brands = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    return report.membership_stats(lines.join(brands, "l_partkey"), ["p_brand"], "l_orderkey", "year")


@registered("widened_years", "SELECT DISTINCT CAST(year(o_orderdate) + d AS INTEGER) AS y FROM orders, (VALUES (-1), (0), (1)) v(d)")
def widened_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Years and their neighbours (AG6)."""
    return report.widened(read(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("y")).distinct(), "y")


@registered("per_day_counts", "SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS n FROM events WHERE CAST(ts AS DATE) >= (SELECT max(CAST(ts AS DATE)) - 6 FROM events) GROUP BY 1, 2")
def per_day_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of the last 7 days (DQ4)."""
    events = read(spark, sf_dir, "events").select("ts", "event_type")
    today = events.agg(F.to_date(F.max("ts"))).first()[0]
    return events.filter(F.to_date("ts") >= values.window_start(F.lit(today), 7)).groupBy(F.to_date("ts").alias("day"), "event_type").agg(F.count(F.lit(1)).alias("n"))


@registered(
    "missing_links",
    """SELECT c_custkey, (SELECT count(*) FROM orders o WHERE o.o_custkey = c_custkey) AS n FROM customer
    WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c_custkey AND o.o_orderstatus = 'F' AND o.o_orderdate >= TIMESTAMP '2000-01-01')""",
)
def missing_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NOT EXISTS with a count beside it (DQ3)."""
    orders = read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderstatus", "o_orderdate")
    linked = orders.filter((F.col("o_orderstatus") == "F") & (F.col("o_orderdate") >= F.lit("2000-01-01").cast("timestamp_ntz")))
    rest = read(spark, sf_dir, "customer").select("c_custkey").join(linked, "c_custkey", "left_anti")
    return rest.join(orders.groupBy("c_custkey").agg(F.count(F.lit(1)).alias("n")), "c_custkey", "left").select("c_custkey", F.coalesce("n", F.lit(0)).alias("n"))


@registered(
    "completeness",
    """SELECT d.doc_id, (SELECT count(*) FROM labels l WHERE l.doc_id = d.doc_id) AS n_labels, (SELECT count(*) FROM conversations c WHERE c.conv_id = d.doc_id) AS n_turns FROM documents d""",
)
def completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of what belongs to each key (DQ2)."""
    labels = read(spark, sf_dir, "labels").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_labels"))
    turns = read(spark, sf_dir, "conversations").groupBy(F.col("conv_id").alias("doc_id")).agg(F.count(F.lit(1)).alias("n_turns"))
    joined = read(spark, sf_dir, "documents").select("doc_id").join(labels, "doc_id", "left").join(turns, "doc_id", "left")
    return joined.select("doc_id", F.coalesce("n_labels", F.lit(0)).alias("n_labels"), F.coalesce("n_turns", F.lit(0)).alias("n_turns"))


@registered("scoped_export", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT') AND l_shipdate >= TIMESTAMP '1997-01-01'")
def scoped_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of a scope by membership, both filters at the scan (DQ5, DQ6, FL1)."""
    scope = read(spark, sf_dir, "orders").filter("o_orderpriority = '1-URGENT'").select(F.col("o_orderkey").alias("l_orderkey"))
    lines = read(spark, sf_dir, "lineitem").filter(F.col("l_shipdate") >= F.lit("1997-01-01").cast("timestamp_ntz")).select("l_orderkey", "l_linenumber", "l_quantity")
    return lines.join(scope, "l_orderkey", "left_semi")


@registered(
    "failure_streaks",
    """WITH x AS (SELECT user_id, event_id, ts, event_type = 'error' AS bad, sum(CASE WHEN event_type = 'error' THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS island FROM events)
    SELECT user_id, max(streak) AS longest FROM (SELECT user_id, sum(CASE WHEN bad THEN 1 ELSE 0 END) OVER (PARTITION BY user_id, island ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS streak FROM x) GROUP BY user_id""",
)
def failure_streaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The longest run of failures of each key (WN5, ST7)."""
    events = read(spark, sf_dir, "events").select("user_id", "event_id", "ts", "event_type")
    streaks = report.failure_streaks(events, ["user_id"], [F.col("ts"), F.col("event_id")], F.col("event_type") == "error")
    return streaks.groupBy("user_id").agg(F.max("streak").alias("longest"))


# ---- ranks, functions, extraction, streaming ----------------------------------------------------------


@registered(
    "composite_rank",
    """SELECT p_brand, p_partkey, rank FROM (SELECT p_brand, p_partkey, row_number() OVER (PARTITION BY p_brand ORDER BY p_type, p_retailprice > 1500 DESC, -least(p_size, 20), p_name, -p_size, p_partkey) AS rank FROM part) WHERE rank <= 2""",
)
def composite_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best two by five keys and a tie key (WN3, SO3)."""
    order = [F.col("p_type"), F.desc(F.col("p_retailprice") > 1500), -F.least(F.col("p_size"), F.lit(20)), F.col("p_name"), -F.col("p_size"), F.col("p_partkey")]
    return pick.top(read(spark, sf_dir, "part"), ["p_brand"], order, 2, "rank").select("p_brand", "p_partkey", F.col("rank").cast("long").alias("rank"))


@registered(
    "tier_fold",
    """WITH s AS (SELECT p_partkey, CAST(floor(p_retailprice) AS INTEGER) AS size FROM part), t1 AS (SELECT *, least(300, size) AS a FROM s),
    t2 AS (SELECT *, CASE WHEN least(600, size) > a * 1.03 THEN least(600, size) END AS b FROM t1), t3 AS (SELECT *, CASE WHEN least(1200, size) > coalesce(b, a) * 1.03 THEN least(1200, size) END AS c FROM t2)
    SELECT p_partkey, concat_ws(',', CAST(a AS VARCHAR), CAST(b AS VARCHAR), CAST(c AS VARCHAR)) AS tiers FROM t3""",
)
def tier_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes that gain 3 % at least (WN7)."""
    return read(spark, sf_dir, "part").select("p_partkey", F.concat_ws(",", pick.tiers(F.floor("p_retailprice")).cast("array<string>")).alias("tiers"))


@registered("json_points", "SELECT event_id, try_cast(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def json_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A typed field of JSON text (SC11, FN18)."""
    return read(spark, sf_dir, "events").select("event_id", F.try_variant_get(F.try_parse_json("props"), "$.k", "bigint").alias("k"))


@registered(
    "html_title_links",
    """SELECT page_id, nullif(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), '') AS title, CAST(len(regexp_extract_all(html, 'href="([^"]*)"', 1)) AS INTEGER) AS n_links FROM pages""",
)
def html_title_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Title and links of each page (SC8)."""
    return read(spark, sf_dir, "pages").select("page_id", markup.title_of(F.col("html")).alias("title"), F.size(markup.links_of(F.col("html"))).alias("n_links"))


@registered(
    "text_key",
    """SELECT doc_id, md5(lower(trim(regexp_replace(translate(text, '«»"“”', ''), '[ \\t\\n\\x0B\\f\\r]+', ' ', 'g')))) AS key FROM documents""",
)
def text_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The comparison key without its script repairs (FN7)."""
    dropped = F.translate("text", text.DROPPED_QUOTES, "")
    return read(spark, sf_dir, "documents").select("doc_id", F.md5(F.lower(F.trim(F.regexp_replace(dropped, r"\s+", " ")))).alias("key"))


@registered("match_key")
def match_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole comparison key of each document (FN7)."""
    return read(spark, sf_dir, "documents").select("doc_id", F.md5(text.match_key(F.col("text"))).alias("key"))


@registered("grouped_number", "SELECT p_partkey, CAST(CAST(p_retailprice AS DECIMAL(14,2)) AS DOUBLE) AS value FROM part")
def grouped_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A price written with grouped digits and a comma, read back (FN10)."""
    written = F.translate(F.format_number(F.col("p_retailprice").cast("decimal(14,2)"), 2), ",.", " ,")
    return read(spark, sf_dir, "part").select("p_partkey", values.grouped_decimal(written, 2).cast("double").alias("value"))


@registered(
    "slug_key",
    """WITH b AS (SELECT p_partkey, coalesce(nullif(trim(regexp_replace(lower(p_name), '[^a-z0-9]+', '-', 'g'), '-'), ''), 'series') AS base FROM part),
    n AS (SELECT p_partkey, base, row_number() OVER (PARTITION BY base ORDER BY p_partkey) AS n FROM b)
    SELECT p_partkey, CASE WHEN n = 1 THEN base ELSE base || '-' || CAST(n AS VARCHAR) END AS slug FROM n""",
)
def slug_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slugs without collisions (FN8, WN6)."""
    part = read(spark, sf_dir, "part").select("p_partkey", text.slug(F.col("p_name")).alias("base"))
    return match.unique_slugs(part, "base", "p_partkey").select("p_partkey", "slug")


@registered(
    "control_point",
    """WITH e AS (SELECT user_id, ts, max(value) AS v, max(CASE WHEN event_type <> 'error' THEN value END) AS sound FROM events GROUP BY 1, 2),
    p AS (SELECT user_id, max(ts) AS last_day, arg_max(sound, ts) AS last_value FROM e WHERE sound IS NOT NULL GROUP BY user_id),
    q AS (SELECT user_id, CASE WHEN max(v) < 400 THEN max(ts) END AS printed_day, CASE WHEN count(*) % 5 > 0 THEN arg_max(v, ts) END AS printed_value FROM e GROUP BY user_id)
    SELECT q.user_id, CASE WHEN printed_value IS NULL THEN 'not_found' WHEN last_day IS NULL THEN 'no_points' WHEN last_value <> printed_value OR printed_day <> last_day THEN 'mismatch' ELSE 'ok' END AS status FROM q LEFT JOIN p ON p.user_id = q.user_id""",
)
def control_point(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last sound point's day and value against the last printed ones (JN22); of several values at one time the largest counts.

    Users with a value of 400 print no day, those with a number of times that five divides no price.
    """
    events = read(spark, sf_dir, "events").groupBy("user_id", "ts").agg(F.max("value").alias("v"), F.max(F.when(F.col("event_type") != "error", F.col("value"))).alias("sound"))
    points = pick.last_point(events.filter("sound is not null"), ["user_id"], "ts", "sound")
    printed = events.groupBy("user_id").agg(F.max("ts").alias("day"), F.max_by("v", "ts").alias("value"), F.max("v").alias("top"), F.count(F.lit(1)).alias("n"))
    printed = printed.select("user_id", F.when(F.col("top") < 400, F.col("day")).alias("printed_day"), F.when(F.col("n") % 5 > 0, F.col("value")).alias("printed_value"))
    return pick.control_point(points, printed, ["user_id"]).select("user_id", "status")


@registered("stream_daily", "SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def stream_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events read as a stream of files; each micro-batch is counted by day under its number, and the counts are added up (ST3, ST4)."""
    root, keys = shared_folder(spark, "stream"), ["day", "event_type"]
    schema = read(spark, sf_dir, "events").schema
    stream = microbatch.file_stream(spark, sf_dir, schema, "events.parquet").select(F.to_date("ts").alias("day"), "event_type")
    store = microbatch.by_batch(f"{root}/counts")  # a batch that runs again, or after a restart, writes its own folder again

    def apply(batch: DataFrame, number: int) -> None:
        store(batch.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")), number)

    stream.writeStream.foreachBatch(apply).option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    try:
        counts = spark.read.parquet(f"{root}/counts")
    except AnalysisException:  # no batch: no files to read
        return spark.createDataFrame([], "day date, event_type string, n long")
    return counts.groupBy(*keys).agg(F.sum("n").alias("n"))
