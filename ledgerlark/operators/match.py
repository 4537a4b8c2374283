"""Deterministic entity matching that reports conflicts instead of guessing. Every join has equality keys."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerlark.functions import text
from ledgerlark.operators.numbering import exploded_range, numbered, spread_join, written


def titles_agree(a: Column, b: Column) -> Column:
    """Equal, or one is the other with more words after a blank (JN3)."""
    return (a == b) | F.startswith(a, F.concat(b, F.lit(" "))) | F.startswith(b, F.concat(a, F.lit(" ")))


def beginnings(title: Column) -> Column:
    """What stands before each blank of a title."""
    words = F.split(title, " ", -1)
    return F.transform(F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))), lambda _, i: F.array_join(F.slice(words, 1, i + 1), " "))


def candidates(cards: DataFrame, rows: DataFrame, band: int = 0) -> DataFrame:
    """(card, row, exact): pairs of equal year (or within the band), value and packaging whose titles agree (JN3, JN4).

    cards: card, year, value, pack, title; rows: row, year, value, pack, title. The band explodes the cards' years, and titles meet
    by equality too: the shorter of two that agree is the other one's beginning, so the join keeps its equality keys and a pair is
    met once.
    """
    c = cards.select("card", "title", F.col("value").alias("cv"), F.col("pack").alias("cp"), "year")
    if band:
        c = c.withColumn("year", F.explode(F.array(*(F.col("year") + d for d in range(-band, band + 1) if d))))
    r = rows.select("row", "title", F.col("value").alias("rv"), F.col("pack").alias("rp"), F.col("year").alias("ry"))
    on = (F.col("year") == F.col("ry")) & (F.col("cv") == F.col("rv")) & F.col("cp").eqNullSafe(F.col("rp")) & (F.col("ct") == F.col("rt"))
    whole_c, whole_r = c.withColumnRenamed("title", "ct"), r.withColumnRenamed("title", "rt")
    every_r = r.select("*", F.posexplode(F.concat(F.array("title"), beginnings(F.col("title")))).alias("cut", "rt"))
    shorter_row = c.select("*", F.explode(beginnings(F.col("title"))).alias("ct")).join(whole_r, on).select("card", "row", F.lit(False).alias("exact"))
    return whole_c.join(every_r, on).select("card", "row", (F.col("cut") == 0).alias("exact")).unionByName(shorter_row)


def with_fallback(cards: DataFrame, rows: DataFrame, band: int = 1) -> DataFrame:
    """Candidates of the same year; only cards without any look at the years beside it (JN4)."""
    same_year = candidates(cards, rows).withColumn("banded", F.lit(False))
    rest = cards.join(same_year.select("card").distinct(), "card", "left_anti")
    return same_year.unionByName(candidates(rest, rows, band).withColumn("banded", F.lit(True)))


def prefer_exact(found: DataFrame) -> DataFrame:
    """Where exactly one candidate of several has the very title, the others go (JN5)."""
    n = F.count_if("exact").over(Window.partitionBy("card"))
    return found.withColumn("__n", n).filter((F.col("__n") != 1) | F.col("exact")).drop("__n")


SUFFIXED = r"(?Us)^(.*?)\s*\(([^()]+)\)\s*$"


def prefer_quality(found: DataFrame, title: str, quality: str) -> DataFrame:
    """Where all of several candidates end in brackets after one base title, and one bracket has the card's quality as its
    comparison key, it stays (JN6); an empty quality decides nothing."""
    w = Window.partitionBy("card")
    base, tail = text.trim(F.regexp_extract(title, SUFFIXED, 1)), F.regexp_extract(title, SUFFIXED, 2)
    hit = F.coalesce((text.match_key(tail) == text.match_key(F.col(quality))) & (F.col(quality) != ""), F.lit(False))
    told = found.withColumns({"__b": base, "__t": tail, "__h": hit})
    decided = (F.min((F.col("__t") != "").cast("int")).over(w) == 1) & (F.min("__b").over(w) == F.max("__b").over(w)) & (F.count_if("__h").over(w) == 1)
    return told.withColumn("__d", decided).filter(~F.col("__d") | F.col("__h")).drop("__b", "__t", "__h", "__d")


def contested(matches: DataFrame, declared: DataFrame | None = None) -> DataFrame:
    """(row, claimants, conflict): a row that several cards claim is a conflict unless they are exactly the declared set (JN7, AG7).

    declared: row, members. Claimants are one row's few cards.
    """
    claims = matches.groupBy("row").agg(F.array_sort(F.collect_set("card")).alias("claimants"))
    if declared is None:
        return claims.withColumn("conflict", F.size("claimants") > 1)
    known = declared.select("row", F.array_sort("members").alias("members"))
    return claims.join(known, "row", "left").select("row", "claimants", ((F.size("claimants") > 1) & ~F.col("claimants").eqNullSafe(F.col("members"))).alias("conflict"))


def match(cards: DataFrame, rows: DataFrame, declared: DataFrame | None = None, band: int = 1) -> DataFrame:
    """(card, status, matched_by, row, year_used, shared_listing, candidates): matched, unmatched, ambiguous (several candidates) or
    contested (several cards) (JN3-JN7).

    matched_by is exact or year_shift; year_used is the row's year; shared_listing marks a row of several declared cards. Among
    several candidates an exact title wins, then the one whose title has the card's quality in brackets (cards' column quality, if there).
    """
    found = prefer_exact(with_fallback(cards, rows, band))
    if "quality" in cards.columns:
        found = prefer_quality(found.join(cards.select("card", "quality"), "card").join(rows.select("row", "title"), "row"), "title", "quality").drop("title", "quality")
    per_card = found.groupBy("card").agg(F.array_sort(F.collect_set("row")).alias("candidates"), F.bool_or("banded").alias("banded"))
    single = per_card.filter(F.size("candidates") == 1).select("card", F.col("candidates")[0].alias("row"))
    claims = contested(single, declared).select("row", F.col("conflict").alias("fight"), (F.size("claimants") > 1).alias("many"))
    told = cards.select("card").join(per_card, "card", "left").join(single, "card", "left").join(claims, "row", "left").join(rows.select("row", F.col("year").alias("year_used")), "row", "left")
    status = F.when(F.col("candidates").isNull(), "unmatched").when(F.size("candidates") > 1, "ambiguous").when(F.col("fight"), "contested").otherwise("matched")
    sure = status == "matched"
    return told.select(
        "card",
        status.alias("status"),
        F.when(sure, F.when(F.col("banded"), "year_shift").otherwise("exact")).alias("matched_by"),
        F.when(sure, F.col("row")).alias("row"),
        F.when(sure, F.col("year_used")).alias("year_used"),
        (sure & F.coalesce("many", F.lit(False))).alias("shared_listing"),
        F.coalesce("candidates", F.array().cast(per_card.schema["candidates"].dataType)).alias("candidates"),
    )


def shared_index(refs: DataFrame, declared: DataFrame) -> DataFrame:
    """(id, card): an id of several cards is dropped whole unless it is declared shared (JN10)."""
    distinct = refs.select("id", "card").dropDuplicates()
    n = distinct.groupBy("id").agg(F.count(F.lit(1)).alias("n"))
    keep = n.join(declared.select("id", F.lit(True).alias("declared")).distinct(), "id", "left").filter("n = 1 or declared").select("id")
    return distinct.join(keep, "id", "left_semi")


def outer_sides(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """(key, side): both, left or right (JN1)."""
    l, r = left.select(F.col(key).alias("__l")).distinct(), right.select(F.col(key).alias("__r")).distinct()
    side = F.when(F.col("__r").isNull(), "left").when(F.col("__l").isNull(), "right").otherwise("both")
    return l.join(r, F.col("__l") == F.col("__r"), "full").select(F.coalesce("__l", "__r").alias(key), side.alias("side"))


def carry_forward(rows: DataFrame, earlier: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Earlier values by key, null where there were none (JN2); the last-written row of a key must be unique."""
    return rows.join(earlier.select(key, *columns), key, "left")


def resolve(rows: DataFrame, reference: DataFrame, on: str, key: str, columns: list[str], required: bool) -> tuple[DataFrame, DataFrame]:
    """(resolved, missing): a required reference that isn't there rejects the row, an optional one leaves nulls (JN11, JN17, JN18)."""
    joined = rows.join(reference.select(F.col(key).alias("__ref"), *columns), F.col(on) == F.col("__ref"), "left")
    lost = F.col("__ref").isNull() & (F.lit(True) if required else F.lit(False))
    return joined.filter(~lost).drop("__ref"), joined.filter(lost).select(*rows.columns)


def unique_inner(items: DataFrame, links: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(adopted, ambiguous): keys with more than one hit are an error branch (JN12)."""
    joined = items.join(links, key).withColumn("__n", F.count(F.lit(1)).over(Window.partitionBy(key)))
    return joined.filter("__n = 1").drop("__n"), joined.filter("__n > 1").drop("__n")


def twins(cards: DataFrame, same: list[str], tailed: Column, key: str) -> DataFrame:
    """(card, twin): each tailed card's first bare twin of equal columns (JN13)."""
    bare = cards.filter(~tailed).groupBy(*same).agg(F.min(key).alias("twin"))
    return cards.filter(tailed).join(bare, same).select(F.col(key).alias("card"), "twin")


def first_known(rows: DataFrame, batch: DataFrame, current: DataFrame, key: str, value: str) -> DataFrame:
    """The value of a reference from the batch, else from the database (JN14)."""
    b, c = batch.select(F.col(key).alias("__b"), F.col(value).alias("__bv")), current.select(F.col(key).alias("__c"), F.col(value).alias("__cv"))
    return rows.join(b, F.col(key) == F.col("__b"), "left").join(c, F.col(key) == F.col("__c"), "left").withColumn(value, F.coalesce("__bv", "__cv")).drop("__b", "__bv", "__c", "__cv")


def twin_links(plans: DataFrame, batch: DataFrame, current: DataFrame, key: str, twin: str, id_column: str, held: str) -> tuple[DataFrame, DataFrame]:
    """(changes, warnings) of references between cards, set in a second pass when all have their ids (JN14).

    plans: key, twin (another card's key, or null). batch: key, id of what this run wrote; current: key, id, held (the reference it
    has). A twin's id comes from the batch, else from what was there; changes (key, old, new) leave out references that are right
    already, and warnings are the plans whose twin neither has.
    """
    told = first_known(plans.filter(F.col(twin).isNotNull()), batch.select(F.col(key).alias(twin), id_column), current.select(F.col(key).alias(twin), id_column), twin, id_column)
    was = current.select(F.col(key).alias("__k"), F.col(held).alias("old"))
    linked = told.filter(F.col(id_column).isNotNull()).join(was, F.col(key) == F.col("__k"), "left").filter(~F.col("old").eqNullSafe(F.col(id_column)))
    return linked.select(key, "old", F.col(id_column).alias("new")), told.filter(F.col(id_column).isNull()).select(*plans.columns)


def overlaps(left: DataFrame, right: DataFrame) -> DataFrame:
    """(a, b, overlap): members that groups a (of left) and b (of right) share, over the members' inverted index (JN15, AG11).

    left: a, member; right: b, member, each pair once.
    """
    return left.join(right, "member").groupBy("a", "b").agg(F.count(F.lit(1)).alias("overlap"))


def greedy_pairs(scores: DataFrame, save: Callable[[DataFrame, int], DataFrame], a_pos: str = "a", b_pos: str = "b") -> DataFrame:
    """One-to-one pairs by falling overlap, ties by a then b (JN15, SO4).

    Edges that are the best of both their ends are what the greedy order takes next among them; they are taken
    together and their ends removed, until none is left. save writes a round's edges down.
    """
    order = [F.desc("overlap"), F.col(a_pos), F.col(b_pos)]
    left, taken, step = save(scores, 0), None, 1
    while not left.isEmpty():
        ranked = left.withColumn("__ra", F.row_number().over(Window.partitionBy("a").orderBy(*order))).withColumn("__rb", F.row_number().over(Window.partitionBy("b").orderBy(*order)))
        best = save(ranked.filter("__ra = 1 and __rb = 1").drop("__ra", "__rb"), step)
        taken = best if taken is None else taken.unionByName(best)
        left = save(left.join(best.select("a"), "a", "left_anti").join(best.select("b"), "b", "left_anti"), step + 1)
        step += 2
    return scores.limit(0) if taken is None else taken


def merge_dictionary(fresh: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    """(key, state): added, kept, vanished, or conflict where a fresh name meets a curated entry (JN16).

    existing has a boolean column curated; a curated entry that isn't met is kept.
    """
    f, e = fresh.select(F.col(key).alias("__f")).distinct(), existing.select(F.col(key).alias("__e"), "curated")
    state = (
        F.when(F.col("__e").isNull(), "added")
        .when(F.col("__f").isNotNull() & F.col("curated"), "conflict")
        .when(F.col("__f").isNull() & ~F.col("curated"), "vanished")
        .otherwise("kept")
    )
    return f.join(e, F.col("__f") == F.col("__e"), "full").select(F.coalesce("__f", "__e").alias(key), state.alias("state"))


def merged_dictionary(fresh: DataFrame, existing: DataFrame, key: str, base: Column, order: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(next, conflicts) of a dictionary (JN16), names compared by their comparison key.

    fresh: key and content, one row a name. existing: key, slug, curated and the same content (null where it lacks a column). A fresh
    name takes the slug of the official entry of its name, the one of the smallest slug if there are several, and its own content
    replaces the old; only a name without an official entry that meets a curated one is a conflict; any other gets a free slug, in
    the order of `order` (the key, if none). Official entries that no fresh name took stay and are flagged missing, curated ones stay
    as they are. With any conflict nothing is merged: next is what there was, and conflicts holds key and the curated slug. next: key,
    slug, curated, missing and the content, ordered by slug.
    """
    content = [c for c in fresh.columns if c not in (key, order)]
    kept = existing.select(key, "slug", "curated", *(F.col("missing") if c == "missing" else F.col(c) if c in existing.columns else F.lit(None).cast(fresh.schema[c].dataType).alias(c) for c in (["missing"] if "missing" in existing.columns else []) + content))
    if "missing" not in kept.columns:
        kept = kept.withColumn("missing", F.lit(False))
    kept = kept.select(key, "slug", "curated", F.coalesce("missing", F.lit(False)).alias("missing"), *content, F.coalesce(text.match_key(F.col(key)), F.lit("")).alias("__key"))
    tiers = kept.groupBy("__key").agg(F.min(F.when(~F.col("curated"), F.col("slug"))).alias("__official"), F.min(F.when(F.col("curated"), F.col("slug"))).alias("__curated"))
    told = written(fresh.withColumn("__key", F.coalesce(text.match_key(F.col(key)), F.lit(""))).withColumn("__base", base).join(tiers, "__key", "left"), "merge")
    conflicts = told.filter("__official is null and __curated is not null").select(key, F.col("__curated").alias("slug"))
    blocked = F.broadcast(conflicts.agg((F.count(F.lit(1)) > 0).alias("__blocked")))  # one row
    matched = told.filter("__official is not null").withColumn("slug", F.col("__official"))
    added = unique_slugs(told.filter("__official is null and __curated is null"), "__base", order or key, "slug", existing.select("slug"))
    taken = matched.select(F.col("slug").alias("__slug")).distinct()
    old = kept.join(taken, (F.col("slug") == F.col("__slug")) & ~F.col("curated"), "left")
    gone = F.col("__slug").isNull() & ~F.col("curated")
    stay = old.crossJoin(blocked).filter("__blocked or __slug is null").select(key, "slug", "curated", F.when(F.col("__blocked"), F.col("missing")).otherwise(gone | F.col("missing")).alias("missing"), *content)
    new = matched.select(key, "slug", *content).unionByName(added.select(key, "slug", *content)).crossJoin(blocked).filter("not __blocked")
    return stay.unionByName(new.select(key, "slug", F.lit(False).alias("curated"), F.lit(False).alias("missing"), *content)).orderBy("slug"), conflicts


def resolve_chain(rows: DataFrame, start: str, steps: list[tuple[str, DataFrame, Column, Column]], out: str) -> tuple[DataFrame, DataFrame]:
    """(resolved, warnings): a value followed from reference to reference (JN17, JN20).

    steps: name, reference, the column of it that the value is compared with, and the one that is the next value; of several entries of a
    value the smallest next one counts. resolved: rows with `out`. warnings: rows with the step that failed and the value that it didn't
    know; a null value fails at the first step. Every step is a join on equality, and a row fails once.
    """
    told = rows.withColumns({"__value": F.col(start), "__failed": F.lit(None).cast("string"), "__lost": F.lit(None).cast("string")})
    for name, reference, given, wanted in steps:
        known = reference.select(given.alias("__given"), wanted.alias("__next")).filter("__given is not null and __next is not null").groupBy("__given").agg(F.min("__next").alias("__next"))
        joined = told.join(known, F.col("__value") == F.col("__given"), "left")
        fails = F.col("__failed").isNull() & F.col("__next").isNull()
        told = joined.select(*rows.columns, F.col("__next").alias("__value"), F.when(fails, F.lit(name)).otherwise(F.col("__failed")).alias("__failed"), F.when(fails, F.col("__value").cast("string")).otherwise(F.col("__lost")).alias("__lost"))
    good, bad = told.filter("__failed is null"), told.filter("__failed is not null")
    return good.select(*rows.columns, F.col("__value").alias(out)), bad.select(*rows.columns, F.col("__failed").alias("step"), F.col("__lost").alias("value"))


def synced(listed: DataFrame, known: DataFrame, id: str, title: str, series: str, known_titles: DataFrame, steps: list[tuple[str, DataFrame, Column, Column]]) -> DataFrame:
    """(kind, detail, id, title) of each listed card that a catalogue lacks (JN19, JN20): what a sync has to do and to report.

    kind is "group" with the resolved series as detail, or a warning: "no id" for a card without an id whose title no known title (any
    column of known_titles) equals by comparison key, or the failing step's name with the value that it didn't know. Known ids and
    titles give no row. The series' name goes through `steps` as its comparison key.
    """
    cards = listed.select(id, title, text.match_key(F.col(series)).alias("__series"))
    idless = unknown_titles(cards.filter(F.col(id).isNull()).filter(F.coalesce(title, F.lit("")) != ""), title, known_titles, known_titles.columns, text.match_key)
    missing = cards.filter(F.col(id).isNotNull()).join(known.select(id), id, "left_anti")
    found, lost = resolve_chain(missing, "__series", steps, "__to")
    rows = [(idless, F.lit("no id"), F.lit(None).cast("string")), (found, F.lit("group"), F.col("__to").cast("string")), (lost, F.col("step"), F.col("value"))]
    first, *rest = (df.select(kind.alias("kind"), detail.alias("detail"), id, title) for df, kind, detail in rows)
    for more in rest:
        first = first.unionByName(more)
    return first


def sync(listed: DataFrame, known: DataFrame, key: str, group: str) -> DataFrame:
    """(group, key, state) of listed keys against those a catalogue has (JN20): new, moved (known under another group), gone or same.

    listed and known: key, group, each key once. A key that is gone is told under the group it had.
    """
    l, k = listed.select(F.col(key).alias("__lk"), F.col(group).alias("__lg")), known.select(F.col(key).alias("__kk"), F.col(group).alias("__kg"))
    state = F.when(F.col("__kk").isNull(), "new").when(F.col("__lk").isNull(), "gone").when(~F.col("__lg").eqNullSafe(F.col("__kg")), "moved").otherwise("same")
    return l.join(k, F.col("__lk") == F.col("__kk"), "full").select(F.when(F.col("__lk").isNull(), F.col("__kg")).otherwise(F.col("__lg")).alias(group), F.coalesce("__lk", "__kk").alias(key), state.alias("state"))


def unlinked(scope: DataFrame, links: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(linked, without): rows of a scope with their link, and those that have none or one without an id (JN8)."""
    told = scope.join(links.select(F.col(key).alias("__k"), F.col("link_id")), F.col(key) == F.col("__k"), "left").drop("__k")
    return told.filter("link_id is not null"), told.filter("link_id is null").drop("link_id")


def with_earlier_notes(rows: DataFrame, earlier: DataFrame, key: str, columns: list[str], note: str = "no earlier card") -> DataFrame:
    """carry_forward with a note on rows that have no earlier one (JN21)."""
    told = rows.join(earlier.select(F.col(key).alias("__k"), *columns), F.col(key) == F.col("__k"), "left")
    return told.withColumn("note", F.when(F.col("__k").isNull(), note)).drop("__k")


def unknown_titles(rows: DataFrame, title: str, known: DataFrame, columns: list[str], key: Callable[[Column], Column]) -> DataFrame:
    """Rows whose comparison key is none of the known titles' in any language (JN19)."""
    listed = known.select(F.explode(F.array(*(key(F.col(c)) for c in columns))).alias("__k")).filter("__k is not null").distinct()
    return rows.withColumn("__key", key(F.col(title))).join(listed, F.col("__key") == F.col("__k"), "left_anti").drop("__key")


#: A name that ends in a number as unique_slugs() writes it, and the name before it.
NUMBERED = r"(?s)^(.*)-([2-9]|[1-9][0-9]{1,14})\z"


def stem_of(name: Column) -> tuple[Column, Column]:
    """(name, number) of base-7, nulls of other names."""
    number = F.regexp_extract(name, NUMBERED, 2)
    return F.when(number != "", F.regexp_extract(name, NUMBERED, 1)), F.nullif(number, F.lit("")).cast("long")


def unique_slugs(rows: DataFrame, base: str, pos: str, out: str = "slug", existing: DataFrame | None = None) -> DataFrame:
    """Each row's base if it is free, else the first free of base-2, base-3 ... in the order of pos, which is unique; existing slugs
    (one column) aren't free (WN6). A null base has no slug.

    It is what going through the rows one by one would give, but a base's rows are numbered by rank: the k-th that needs a number
    gets the k-th number that isn't taken. Taken are existing slugs, and numbered names that are bases themselves ("a-2" beside
    "a"), unless a row of "a" needs that number before the first row of "a-2" comes. Whether it does depends on smaller numbers alone, so
    that question is settled in rounds, as many as answers still change. A base's own name may have gone to a row of its stem, so
    stems are done before the names that end in one more number. Only bases with taken numbers are joined with their free ones.
    """
    named = rows.filter(F.col(base).isNotNull()).select(F.col(base).alias("__base"), F.col(pos).alias("__pos"))
    ranked = numbered(named, ["__base"], ["__pos"], "__r")
    total = ranked.count()
    stem, number = stem_of(F.col("__base"))
    bases = ranked.groupBy("__base").agg(F.min("__pos").alias("__first"), F.count(F.lit(1)).alias("__m"))
    depth = F.length(F.regexp_replace(F.regexp_extract("__base", r"(?s)((-([2-9]|[1-9][0-9]{1,14}))*)\z", 1), "[^-]", ""))
    bases = bases.withColumns({"__stem": stem, "__n": number, "__depth": depth})
    old = None if existing is None else existing.select(F.col(existing.columns[0]).alias("__name")).filter("__name is not null").distinct()
    children = bases.select(F.col("__stem").alias("__parent"), "__n", F.col("__first").alias("__f")).filter("__parent is not null").join(bases.select(F.col("__base").alias("__parent")), "__parent", "left_semi")
    levels = [r[0] for r in bases.join(children.select(F.col("__parent").alias("__base")), "__base", "left_semi").select("__depth").distinct().collect()]  # few
    deep = sorted({d for x in levels for d in (x, x + 1)})
    given = None
    for level in [*deep, None]:
        # The bases of this level; at the end all that neither are nor have a stem among the bases.
        mine = bases.filter(F.col("__depth") == level) if level is not None else bases.filter(~F.col("__depth").isin(deep)) if deep else bases
        taken = None if old is None else old
        if given is not None:
            stems = given.join(mine.select(F.col("__base").alias("__name"), "__first"), "__name").filter("__pos < __first").select("__name")
            taken = stems if taken is None else taken.unionByName(stems)
        mine = mine.withColumn("__own", F.lit(True)) if taken is None else mine.join(taken.distinct().select(F.col("__name").alias("__base"), F.lit(True).alias("__gone")), "__base", "left").withColumn("__own", F.col("__gone").isNull())
        fixed = None
        if old is not None:
            name, n = stem_of(F.col("__name"))
            fixed = old.select(name.alias("__base"), n.alias("__n")).filter("__n is not null").join(mine.select("__base"), "__base", "left_semi")
        # Whether a base has taken numbers is told with its rows; where other bases may take some, only when those are known.
        busy = F.lit(None).cast("boolean") if level is not None else F.lit(False)
        if level is None and fixed is not None:
            mine = mine.join(fixed.select("__base", F.lit(True).alias("__fixed")).distinct(), "__base", "left")
            busy = F.coalesce("__fixed", F.lit(False))
        asks = spread_join(ranked, mine.select("__base", "__own", "__m", busy.alias("__busy")), "__base", "__m", total).withColumn("__k", F.col("__r") - F.col("__own").cast("long"))
        asks = written(asks.select("__base", "__pos", "__k", "__m", "__busy"), "asks")
        held = fixed
        if level is not None:
            held = _held_numbers(asks, fixed, children.join(mine.select(F.col("__base").alias("__parent")), "__parent", "left_semi"))
            taken_of = mine.select("__base", "__m").join(held.select("__base").distinct(), "__base", "left_semi")
            asks = spread_join(asks, taken_of, "__base", "__m", total, "left_semi").withColumn("__busy", F.lit(True)).unionByName(spread_join(asks, taken_of, "__base", "__m", total, "left_anti").withColumn("__busy", F.lit(False)))
        told = _with_numbers(asks, held).select("__pos", F.when(F.col("__k") == 0, F.col("__base")).otherwise(F.concat_ws("-", "__base", "__number")).alias("__name"))
        told = told if level is None else written(told, "given")
        given = told if given is None else given.unionByName(told)
    return rows.join(given.withColumnRenamed("__name", out), F.col(pos) == F.col("__pos"), "left").drop("__pos")


def _free(asks: DataFrame, held: DataFrame) -> DataFrame:
    """(base, number, place): the numbers from 2 that bases with held ones can need, without those, in order."""
    needs = held.groupBy("__base").agg(F.count(F.lit(1)).alias("__h")).join(asks.groupBy("__base").agg(F.first("__m").alias("__m")), "__base")
    every = exploded_range(needs.select("__base", (F.col("__m") + F.col("__h") + 1).alias("__upto")), F.lit(2), F.col("__upto"), "__number").select("__base", "__number")
    return numbered(every.join(held.select("__base", F.col("__n").alias("__number")).distinct(), ["__base", "__number"], "left_anti"), ["__base"], ["__number"], "__place")


def _with_numbers(asks: DataFrame, held: DataFrame | None) -> DataFrame:
    """asks with __number, the k-th free one of its base, as text."""
    plain = asks.filter("not __busy").withColumn("__number", (F.col("__k") + 1).cast("string"))
    if held is None:
        return plain
    free = _free(asks.filter("__busy"), held).select("__base", F.col("__place").alias("__k"), F.col("__number").cast("string").alias("__number"))
    return plain.unionByName(asks.filter("__busy").join(free, ["__base", "__k"], "left"))


def _held_numbers(asks: DataFrame, fixed: DataFrame | None, children: DataFrame) -> DataFrame:
    """The fixed numbers and those of children whose first row comes before the row that would need their number."""
    kids = children.select(F.col("__parent").alias("__base"), "__n", "__f")
    if fixed is not None:
        kids = kids.join(fixed, ["__base", "__n"], "left_anti")
        places = _free(asks, fixed).select("__base", F.col("__number").alias("__n"), "__place")
        kids = kids.join(places, ["__base", "__n"], "left").join(fixed.select("__base").distinct().withColumn("__some", F.lit(True)), "__base", "left")
        kids = kids.withColumn("__e", F.when(F.col("__some"), F.col("__place")).otherwise(F.col("__n") - 1)).drop("__place", "__some")
    else:
        kids = kids.withColumn("__e", F.col("__n") - 1)
    # Numbers beyond what a base can need have no place.
    kids, below = written(kids.filter("__e is not null").withColumn("__held", F.lit(False)), "kids"), Window.partitionBy("__base").orderBy("__n").rowsBetween(Window.unboundedPreceding, -1)
    while True:
        at = kids.withColumn("__k", F.col("__e") - F.coalesce(F.sum(F.col("__held").cast("long")).over(below), F.lit(0)))
        told = at.join(asks.select("__base", "__k", F.col("__pos").alias("__who")), ["__base", "__k"], "left")
        told = written(told.select("__base", "__n", "__f", "__e", F.coalesce(F.col("__who") > F.col("__f"), F.lit(True)).alias("__held"), F.col("__held").alias("__before")), "kids")
        kids = told.drop("__before")
        if told.filter("__held <> __before").isEmpty():
            held = kids.filter("__held").select("__base", "__n")
            return held if fixed is None else held.unionByName(fixed.select("__base", "__n"))
