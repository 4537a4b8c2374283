"""Writes as pure functions: (current, batch) -> (next, outcome). Parquet has no MERGE, so the next state is a new table.

Keys are compared null-safely throughout. A column that a batch lacks is left as it is; a null that it has is written.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerlark.operators.numbering import numbered

def one_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in a total order (WN4); nulls are one key."""
    rn = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__rn", rn).filter("__rn = 1").drop("__rn")


def append_new(current: DataFrame, batch: DataFrame, keys: list[str], order: list[Column], outcome_by: str) -> tuple[DataFrame, DataFrame]:
    """Idempotent append (SK2): one row a key of the batch, and of those the keys that aren't there yet.

    The outcome counts new rows by outcome_by (AG5). A second run appends nothing.
    """
    rows = one_per_key(batch, keys, order)
    new = _anti(rows, current, keys)
    return current.unionByName(new), new.groupBy(outcome_by).agg(F.count(F.lit(1)).alias("inserted"))


def _renamed(df: DataFrame, columns: list[str], prefix: str) -> DataFrame:
    return df.select(*(F.col(c).alias(prefix + c) for c in columns))


def _matches(keys: list[str], prefix: str) -> Column:
    return reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(prefix + k)) for k in keys))


def _anti(rows: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    return rows.join(_renamed(other, keys, "__o_"), _matches(keys, "__o_"), "left_anti")


def correct_recent(current: DataFrame, batch: DataFrame, keys: list[str], values: list[str], compare: str, recent: Column, mine: Column | None = None, order: list[Column] | None = None) -> tuple[DataFrame, DataFrame]:
    """Correction in place (SK3): rows of the same key get the batch's values if they are recent, ours, and `compare` differs.

    Returns (next, changed): changed holds the keys with the old and new value of compare.
    """
    fresh = one_per_key(batch, keys, order or [F.col(v) for v in values])
    theirs = fresh.select(*(F.col(k).alias("__n_" + k) for k in keys), *(F.col(v).alias("__n_" + v) for v in values), F.lit(True).alias("__hit"))
    joined = current.join(theirs, _matches(keys, "__n_"), "left")
    change = F.coalesce(F.col("__hit") & recent & (F.lit(True) if mine is None else mine) & ~F.col(compare).eqNullSafe(F.col("__n_" + compare)), F.lit(False))
    marked = joined.withColumn("__change", change)
    following = marked.select(*(F.when(F.col("__change"), F.col("__n_" + c)).otherwise(F.col(c)).alias(c) if c in values else F.col(c) for c in current.columns))
    changed = marked.filter("__change").select(*keys, F.col(compare).alias("old"), F.col("__n_" + compare).alias("new"))
    return following, changed


def merge_recent(current: DataFrame, rows: DataFrame, keys: list[str], compare: str, recent: Column) -> DataFrame:
    """Append and correction in one join (SK2, SK3): current's columns and the outcome of each key: kept, inserted, corrected or repeated.

    rows has one row a key and current's columns. A key that is there takes the new values if it is recent, judged by current's
    row, and `compare` differs; else it is repeated and stays.
    """
    new = rows.select(*(F.col(c).alias("__n_" + c) for c in current.columns), F.lit(True).alias("__new"))
    both = current.withColumn("__old", F.lit(True)).join(new, _matches(keys, "__n_"), "full")
    change = F.coalesce(recent & ~F.col(compare).eqNullSafe(F.col("__n_" + compare)), F.lit(False))
    outcome = F.when(F.col("__new").isNull(), "kept").when(F.col("__old").isNull(), "inserted").when(change, "corrected").otherwise("repeated")
    told = both.withColumn("__outcome", outcome)
    return told.select(*(F.when(F.col("__outcome").isin("inserted", "corrected"), F.col("__n_" + c)).otherwise(F.col(c)).alias(c) for c in current.columns), F.col("__outcome").alias("outcome"))


def scoped_delete(current: DataFrame, victims: Column, scope: DataFrame, key: str, enabled: bool = True) -> tuple[DataFrame, DataFrame]:
    """Delete rows that meet `victims` for the keys of this run alone (SK4); the outcome counts them by key, deleted or not."""
    keys = scope.select(F.col(key).alias("__key")).distinct()
    hit = current.filter(victims).join(keys, F.col(key) == F.col("__key"), "left_semi")
    outcome = hit.groupBy(key).agg(F.count(F.lit(1)).alias("removed" if enabled else "would_remove"))
    if not enabled:
        return current, outcome
    kept = current.filter(~F.coalesce(victims, F.lit(False))).unionByName(current.filter(victims).join(keys, F.col(key) == F.col("__key"), "left_anti"))
    return kept, outcome


def upsert(current: DataFrame, batch: DataFrame, keys: list[str], values: list[str]) -> tuple[DataFrame, DataFrame]:
    """Full-row upsert with the outcome inserted, updated or unchanged of each batch row (SK5); one join gives both."""
    old = current.select(*(F.col(c).alias("__o_" + c) for c in keys + values), F.lit(True).alias("__old"))
    new = batch.select(*keys, *values, F.lit(True).alias("__new"))
    both = new.join(old, _matches(keys, "__o_"), "full")
    differs = reduce(lambda a, b: a | b, (~F.col(v).eqNullSafe(F.col("__o_" + v)) for v in values))
    status = F.when(F.col("__new").isNull(), "kept").when(F.col("__old").isNull(), "inserted").when(differs, "updated").otherwise("unchanged")
    told = both.withColumn("outcome", status)
    pick = [F.when(F.col("__new").isNull(), F.col("__o_" + c)).otherwise(F.col(c)).alias(c) for c in keys + values]
    return told.select(*pick), told.filter("outcome <> 'kept'").select(*keys, "outcome")


def diff_rows(current: DataFrame, intended: DataFrame, key: str, columns: list[str], present: str | None = None, protected: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Column-wise upsert of existing rows (SK6, SK7): columns that `present` doesn't name, or that `protected` names, are left alone.

    Returns (next, log): one log row (key, col, old, new) for each column that changes.
    """
    plan = intended.select(F.col(key).alias("__key"), *(F.col(c).alias("__i_" + c) for c in columns), *([F.col(present).alias("__present")] if present else []), F.lit(True).alias("__hit"))
    both = current.join(plan, F.col(key) == F.col("__key"), "left")

    def changes(c: str) -> Column:
        given = F.array_contains("__present", c) if present else F.lit(True)
        free = ~F.coalesce(F.array_contains(protected, c), F.lit(False)) if protected else F.lit(True)
        return F.coalesce(F.col("__hit") & given & free & ~F.col(c).eqNullSafe(F.col("__i_" + c)), F.lit(False))

    log = F.filter(F.array(*(F.when(changes(c), F.struct(F.lit(c).alias("col"), F.col(c).cast("string").alias("old"), F.col("__i_" + c).cast("string").alias("new"))) for c in columns)), lambda x: x.isNotNull())
    following = both.select(*(F.when(changes(c), F.col("__i_" + c)).otherwise(F.col(c)).alias(c) if c in columns else F.col(c) for c in current.columns))
    return following, both.select(key, F.explode(log).alias("x")).select(key, "x.*")


def upsert_links(current: DataFrame, batch: DataFrame, keys: list[str], values: list[str], stamp: str, now: Column) -> DataFrame:
    """Links whose values are the same keep their time stamp; others get a new one (SK8)."""
    old = current.select(*(F.col(c).alias("__o_" + c) for c in [*keys, *values, stamp]), F.lit(True).alias("__old"))
    both = batch.select(*keys, *values, F.lit(True).alias("__new")).join(old, _matches(keys, "__o_"), "full")
    equal = reduce(lambda a, b: a & b, (F.col(v).eqNullSafe(F.col("__o_" + v)) for v in values)) & F.col("__old").isNotNull()
    gone = F.col("__new").isNull()
    pick = [F.when(gone, F.col("__o_" + c)).otherwise(F.col(c)).alias(c) for c in keys + values]
    return both.select(*pick, F.when(gone | equal, F.col("__o_" + stamp)).otherwise(now).alias(stamp))


def replace_groups(current: DataFrame, batch: DataFrame, group: list[str], shared: Column, compare: list[str]) -> tuple[DataFrame, DataFrame]:
    """Each group of the batch replaces the shared rows of that group (SK9), unless exactly one row with equal values is there.

    The batch has one row a group. Returns (next, outcome) with outcome replaced or unchanged.
    """
    new = batch.select(*(F.col(g).alias("__g_" + g) for g in group), F.struct(*compare).alias("__want"))
    held = current.filter(shared).groupBy(*group).agg(F.count(F.lit(1)).alias("__n"), F.min(F.struct(*compare)).alias("__have"))
    status = new.join(held, _matches(group, "__g_"), "left").select(*(F.col("__g_" + g).alias(g) for g in group), F.when((F.coalesce("__n", F.lit(0)) == 1) & F.col("__have").eqNullSafe(F.col("__want")), "unchanged").otherwise("replaced").alias("outcome"))
    replaced = status.filter("outcome = 'replaced'")
    kept = current.filter(~F.coalesce(shared, F.lit(False))).unionByName(_anti(current.filter(shared), replaced, group))
    return kept.unionByName(batch.join(_renamed(replaced, group, "__r_"), _matches(group, "__r_"), "left_semi"), allowMissingColumns=True), status


def get_or_create(dimension: DataFrame, rows: DataFrame, keys: list[str], id_column: str, derived: dict[str, Column] | None = None) -> DataFrame:
    """The dimension with the rows' new keys added under the next ids, in key order (SK10, SK7).

    Ids come from one written ordering, so they hold whatever reads them later; no task sees all new keys. derived: further columns of
    the dimension, computed from the keys of new entries. Rows with a null key part add nothing.
    """
    derived = derived or {}
    wanted = rows.select(*keys).dropna().distinct()
    placed = numbered(_anti(wanted, dimension, keys), [], keys, "__place")
    top = dimension.agg(F.coalesce(F.max(id_column), F.lit(0)).alias("__top"))
    added = placed.crossJoin(F.broadcast(top))  # one row
    new = added.select(*keys, (F.col("__top") + F.col("__place")).cast(dimension.schema[id_column].dataType).alias(id_column), *(c.alias(n) for n, c in derived.items()))
    return dimension.select(*keys, id_column, *derived).unionByName(new)


def upsert_dictionary(current: DataFrame, ids: DataFrame, entries: DataFrame, slug: str, id_column: str, columns: list[str], vanished: str, present: str | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(next, ids, report) of a dictionary's entries against the rows that they have (SK7).

    current: id and columns. ids: slug and id, each slug once. entries: slug, columns, a boolean `vanished`, and `present` (names of the
    columns that an entry has; all, if none is named). Vanished entries are skipped. An entry whose slug has an id updates that row column by
    column; one without gets the next id, in the order of slugs, from one written ordering. report: slug, id, action (skip, update,
    unchanged, insert, or lost where the id's row isn't there, which changes nothing) and changes, an array of struct(col, old, new).
    """
    kind = current.schema[id_column].dataType
    wanted = entries.select(slug, *columns, F.coalesce(vanished, F.lit(False)).alias("__skip"), (F.col(present) if present else F.array(*map(F.lit, columns))).alias("__present"))
    told = wanted.join(ids.select(F.col(slug).alias("__s"), F.col(id_column).alias("__id")), F.col(slug) == F.col("__s"), "left").drop("__s")
    fresh = numbered(told.filter("not __skip and __id is null").drop("__id"), [], [slug], "__place")
    top = current.agg(F.max(id_column).alias("t")).unionByName(ids.agg(F.max(id_column).alias("t"))).agg(F.coalesce(F.max("t"), F.lit(0)).alias("__top"))
    new = fresh.crossJoin(F.broadcast(top)).withColumn("__id", (F.col("__top") + F.col("__place")).cast(kind)).drop("__top", "__place")  # one row
    known = told.filter("not __skip and __id is not null")
    old = current.select(F.col(id_column).alias("__have"), *(F.col(c).alias("__c_" + c) for c in columns))
    both = known.join(old, F.col("__id") == F.col("__have"), "left")

    def change(c: str, was: Column) -> Column:
        given = F.array_contains("__present", c) & ~F.col(c).eqNullSafe(was)
        return F.when(given, F.struct(F.lit(c).alias("col"), was.cast("string").alias("old"), F.col(c).cast("string").alias("new")))

    def log(was: dict[str, Column]) -> Column:
        return F.filter(F.array(*(change(c, was[c]) for c in columns)), lambda x: x.isNotNull())

    met = both.withColumn("__changes", F.when(F.col("__have").isNotNull(), log({c: F.col("__c_" + c) for c in columns})))
    action = F.when(F.col("__have").isNull(), "lost").when(F.size("__changes") > 0, "update").otherwise("unchanged")
    nothing = {c: F.lit(None).cast(entries.schema[c].dataType) for c in columns}
    inserted = new.select(slug, F.col("__id").alias(id_column), F.lit("insert").alias("action"), log(nothing).alias("changes"))
    empty = F.array().cast(inserted.schema["changes"].dataType)
    skipped = told.filter("__skip").select(slug, F.col("__id").alias(id_column), F.lit("skip").alias("action"), empty.alias("changes"))
    report = met.select(slug, F.col("__id").alias(id_column), action.alias("action"), F.coalesce("__changes", empty).alias("changes")).unionByName(inserted).unionByName(skipped)
    given = {c: F.array_contains("__present", c) for c in columns}
    changed = met.filter("__have is not null").select(F.col("__id").alias(id_column), *(F.when(given[c], F.col(c)).otherwise(F.col("__c_" + c)).alias(c) for c in columns))
    rows = new.select(F.col("__id").alias(id_column), *(F.when(given[c], F.col(c)).alias(c) for c in columns))
    rest = current.join(changed.select(F.col(id_column).alias("__id")), F.col(id_column) == F.col("__id"), "left_anti").select(id_column, *columns)
    following = rest.unionByName(changed).unionByName(rows)
    return following, ids.select(slug, id_column).unionByName(new.select(slug, F.col("__id").alias(id_column))), report
