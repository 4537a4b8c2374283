"""One of many: newest, preferred, best."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def top(df: DataFrame, group: list[str], order: list[Column], n: int = 1, rank: str | None = None) -> DataFrame:
    """The first n rows of each group in a total order (DQ1, WN3, WN4, SO3); Spark cuts groups before the shuffle."""
    name = rank or "__rn"
    out = df.withColumn(name, F.row_number().over(Window.partitionBy(*group).orderBy(*order))).filter(F.col(name) <= n)
    return out if rank else out.drop(name)


def largest(df: DataFrame, group: list[str], width: Column, height: Column, pos: str) -> DataFrame:
    """Each group's row of the largest area, the first of several (AG9); rows without a size count only if all lack one.

    One aggregation without a window: tasks keep a row a group before anything is shuffled.
    """
    rows = F.struct(*(F.col(c) for c in df.columns if c not in group))
    best = F.max_by(rows, F.struct(F.coalesce(width.cast("long") * height.cast("long"), F.lit(-1)).alias("area"), (-F.col(pos)).alias("first")))
    return df.groupBy(*group).agg(best.alias("__best")).select(*group, "__best.*")


def newest(df: DataFrame, id: Column, n: int, tie: list[str]) -> DataFrame:
    """The n rows of the largest numeric ids (SO1, SO2): each task keeps n, and only those are merged."""
    return df.orderBy(id.desc_nulls_last(), *tie).limit(n)


def preferred(df: DataFrame, group: list[str], prefer: Column, order: list[Column]) -> DataFrame:
    """A group's first row among the preferred ones, else among all (JN9)."""
    return top(df, group, [F.coalesce(prefer, F.lit(False)).desc(), *order])


def pick_best(df: DataFrame, group: list[str], accepted: Column, score: Column, page_order: Column, n: int = 2) -> DataFrame:
    """Accepted ones by score, then page order; if all are rejected, the page's head, flagged as fallback (SO3)."""
    some = F.max(accepted.cast("int")).over(Window.partitionBy(*group)) == 1
    told = df.withColumn("__some", some)
    keys = [F.when(F.col("__some"), (~accepted).cast("int")), F.when(F.col("__some"), -score), page_order]
    return top(told, group, keys, n, "pick").withColumn("fallback", ~F.col("__some")).drop("__some")


def last_point(df: DataFrame, group: list[str], day: str, value: str) -> DataFrame:
    """Each group's value on its last day (JN22)."""
    return df.groupBy(*group).agg(F.max(day).alias("last_day"), F.max_by(value, day).alias("last_value"))


def control_point(points: DataFrame, printed: DataFrame, group: list[str]) -> DataFrame:
    """not_found (no printed price), no_points, ok or mismatch: the last point against what a page prints (JN22).

    The values must be equal; the days too, if the page prints one.
    """
    both = printed.join(points, group, "full")
    differs = ~F.col("last_value").eqNullSafe(F.col("printed_value")) | (F.col("printed_day").isNotNull() & ~F.col("last_day").eqNullSafe(F.col("printed_day")))
    status = F.when(F.col("printed_value").isNull(), "not_found").when(F.col("last_day").isNull(), "no_points").when(differs, "mismatch").otherwise("ok")
    return both.withColumn("status", status)


def tiers(size: Column, targets: tuple[int, ...] = (300, 600, 1200), least_gain: float = 1.03) -> Column:
    """Output sizes of an image (WN7, SK16): each target once, never above the source, each more than 3 % above the last."""
    start = F.array().cast("array<int>")
    percent = round(least_gain * 100)

    def step(acc: Column, t: Column) -> Column:
        width = F.least(t, size.cast("int"))
        last = F.coalesce(F.get(acc, F.size(acc) - 1), F.lit(0))
        return F.when(width * 100 > last * percent, F.concat(acc, F.array(width))).otherwise(acc)

    return F.when(size.isNull(), start).otherwise(F.aggregate(F.array(*map(F.lit, targets)), start, step))


def roles(photos: DataFrame, card: str, pos: str, said: str, shape_ok: Column, score: Column) -> DataFrame:
    """The pools of a card's obverse and reverse (WN8): each photo that a caption names, and where no named one has the right shape,
    the first unnamed one in page order that has; where nothing is named and no unnamed one has it, the best by score.

    Adds role and how (caption, shape or score). The obverse takes its unnamed photo before the reverse does. In a pool, a right
    shape goes before a wrong one, then page order; `rank` says where a photo stands.
    """
    ok = F.coalesce(shape_ok, F.lit(False))
    told = photos.withColumns({"__ok": ok, "__score": score})
    named = told.filter(F.col(said).isin("obverse", "reverse")).select("*", F.col(said).alias("role"), F.lit("caption").alias("how"))
    free = told.filter(F.col(said).isNull())
    backed = named.groupBy(card).agg(*(F.coalesce(F.bool_or(F.col("__ok") & (F.col("role") == r)), F.lit(False)).alias(f"__{r}_ok") for r in ("obverse", "reverse")), *(F.bool_or(F.col("role") == r).alias(f"__{r}_some") for r in ("obverse", "reverse")))
    free = free.join(backed, card, "left")
    page = Window.partitionBy(card).orderBy(F.desc("__ok"), F.when(F.col("__ok"), F.col(pos)), F.desc("__score"), F.col(pos))
    # What a role asks of the unnamed: nothing if its caption is backed, else the first of this order, which must have the shape if something is named.
    free = free.withColumn("__turn", F.row_number().over(page)).withColumn("__good", F.count_if("__ok").over(Window.partitionBy(card)))
    needs = {r: ~F.coalesce(f"__{r}_ok", F.lit(False)) for r in ("obverse", "reverse")}
    bare = {r: ~F.coalesce(f"__{r}_some", F.lit(False)) for r in ("obverse", "reverse")}
    first = needs["obverse"] & ((F.col("__good") >= 1) | bare["obverse"])
    obverse = F.when(first, 1).otherwise(0)
    reverse = obverse + 1
    second = needs["reverse"] & ((F.col("__good") >= reverse) | bare["reverse"])
    role = F.when(first & (F.col("__turn") == 1), "obverse").when(second & (F.col("__turn") == reverse), "reverse")
    rescued = free.withColumn("role", role).filter("role is not null").withColumn("how", F.when(F.col("__ok"), "shape").otherwise("score"))
    pools = named.unionByName(rescued.select(*named.columns))
    order = Window.partitionBy(card, "role").orderBy(F.desc("__ok"), pos)
    return pools.withColumn("rank", F.row_number().over(order)).drop("__ok", "__score")
