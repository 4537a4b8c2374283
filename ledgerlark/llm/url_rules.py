"""URL filter: a sort-merge range join of reversed-host keys with nested prefix rules.

A host's labels, reversed and each ended by a dot, turn "this host and all its subdomains" into a key
prefix, and a prefix into an interval: from the prefix itself to the prefix with the dot replaced by the
next character. For each distinct rule path, the urls whose path starts with it take part under that
path, so that a rule on host and path is one interval too. Urls are first reduced to distinct keys.
Keys and interval bounds are then sorted together and swept: the bounds carry the top of the stack of
rules that are active from there on, and a key takes the last bound's top. The sweep runs in salted
slices of the keys, each with all bounds, so one hot host or domain doesn't meet in one task; the rules
are configuration, their number is checked, and the stack is kept by one pass over the sorted rules.

Defined results: a null url and a url without "://" have an empty host and path, and no rule fits an
empty host; a rule listed twice counts once, and of two verdicts for the same rule the first listed
holds; other columns of the input are left out, so names can't clash; no pages give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerlark.llm.common import Scratch

#: verdict, host, path
RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]
#: Rules are copied to each slice of the sweep, so their number is bounded.
MAX_RULES = 100_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(rest, UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def host_key(host: Column) -> Column:
    """com.example.www. of www.example.com; empty of an empty host."""
    return F.when(host == "", F.lit("")).otherwise(F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), "."), F.lit(".")))


def key_of(host: str) -> str:
    return ".".join(reversed(host.split("."))) + "."


def bounds(rules: list[tuple[str, str, str]]) -> list[tuple[str, str, int, str | None, str | None]]:
    """(path, key, order, top rule, its verdict): what is on top of the stack from this key on.

    At one key, ends come before starts, and starts before the urls' keys.
    """
    if len(rules) > MAX_RULES:
        raise ValueError(f"{len(rules)} rules; at most {MAX_RULES}")
    by_path: dict[str, dict[str, tuple[str, str]]] = {}
    for verdict, host, path in rules:
        by_path.setdefault(path, {}).setdefault(key_of(host), (host + path, verdict))
    out: list[tuple[str, str, int, str | None, str | None]] = []
    for path, named in by_path.items():
        stack: list[str] = []

        def close(stack=stack, path=path, named=named):
            ended = stack.pop()
            out.append((path, ended[:-1] + "/", 0, *(named[stack[-1]] if stack else (None, None))))

        for key in sorted(named):
            while stack and not key.startswith(stack[-1]):
                close()
            stack.append(key)
            out.append((path, key, 1, *named[key]))
        while stack:
            close()
    return out


def literal_rows(rows: list[tuple], names: list[str]) -> Column:
    return F.array(*(F.struct(*(F.lit(v).cast("int" if isinstance(v, int) else "string").alias(n) for n, v in zip(names, row, strict=True))) for row in rows))


def judge(pages: DataFrame, rules: list[tuple[str, str, str]] | None = None, default: str = "allow", slices: int | None = None) -> DataFrame:
    """page_id, host, path, rule (the longest that fits, else null), verdict (its verdict, else default).

    The longest rule is the one with the most characters in host and path, of equals the one with the longer host.
    """
    rules = RULES if rules is None else rules
    spark = pages.sparkSession
    urls = pages.select(F.col("page_id"), host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    paths = sorted({path for _, _, path in rules})
    if not paths:
        return urls.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(default)})
    slices = slices or int(spark.conf.get("spark.sql.shuffle.partitions"))
    fitting = F.filter(F.array(*map(F.lit, paths)), lambda p: F.startswith(F.col("path"), p))
    urls = urls.withColumn("paths", fitting)
    keys = (
        urls.filter((F.size("paths") > 0) & (F.col("host") != ""))
        .select("host", F.explode("paths").alias("rule_path"))
        .groupBy("host", "rule_path")
        .agg(F.lit(2).alias("kind"))
        .withColumns({"key": host_key(F.col("host")), "slice": F.pmod(F.xxhash64("host", "rule_path"), F.lit(slices)).cast("int"), "top": F.lit(None).cast("string"), "top_verdict": F.lit(None).cast("string")})
    )
    marks = (
        spark.range(slices)
        .select(F.col("id").cast("int").alias("slice"), F.inline(literal_rows(bounds(rules), ["rule_path", "key", "kind", "top", "top_verdict"])))
        .withColumn("host", F.lit(None).cast("string"))
    )
    sweep = Window.partitionBy("slice", "rule_path").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # A bound where nothing is active carries null, so the carried value is a struct that is null on keys alone.
    mark = F.when(F.col("kind") < 2, F.struct("top", "top_verdict"))
    names = ["slice", "rule_path", "key", "kind", "host", "top", "top_verdict"]
    swept = (
        keys.select(*names)
        .unionByName(marks.select(*names))
        .select("slice", "rule_path", "key", "kind", "host", F.last(mark, ignorenulls=True).over(sweep).alias("mark"))
        .filter((F.col("kind") == 2) & F.col("mark.top").isNotNull())
        .select("host", F.struct(F.length("mark.top").alias("size"), (-F.length("rule_path")).alias("host_size"), F.col("mark.top").alias("rule"), F.col("mark.top_verdict").alias("verdict"), "rule_path").alias("found"))
    )
    # One row for each host with its best rule of each path; a page keeps those whose path fits it.
    per_host = swept.groupBy("host").agg(F.collect_list("found").alias("found"))
    # Written down, so that the join below deals both sides out itself and a hot host's pages can be split.
    per_host = Scratch(spark, "url-rules").save(per_host, "hosts")
    joined = urls.join(per_host, "host", "left")
    best = F.array_max(F.filter(F.col("found"), lambda f: F.array_contains(F.col("paths"), f["rule_path"])))
    return joined.select("page_id", "host", "path", best.alias("best")).select(
        "page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce(F.col("best.verdict"), F.lit(default)).alias("verdict")
    )


ORACLE_SQL = """
WITH u AS (
  SELECT page_id,
         translate(coalesce(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
r(verdict, rhost, rpath) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
f AS (
  SELECT page_id, rhost || rpath AS rule, verdict,
         row_number() OVER (PARTITION BY page_id ORDER BY length(rhost || rpath) DESC, length(rhost) DESC) AS rn
  FROM u JOIN r ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath))
SELECT u.page_id, host, path, f.rule AS rule, coalesce(f.verdict, 'allow') AS verdict
FROM u LEFT JOIN f ON u.page_id = f.page_id AND f.rn = 1
"""
