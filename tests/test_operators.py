from datetime import date, datetime

from pyspark.sql import functions as F

from ledgerlark.operators import match, pick, report, upsert, validate


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_append_is_idempotent_and_null_safe(spark):
    current = spark.createDataFrame([(1, None, 5.0), (2, "a", 6.0)], "k int, g string, p double")
    batch = spark.createDataFrame([(1, None, 7.0), (1, "a", 8.0), (1, "a", 3.0), (3, None, 9.0)], "k int, g string, p double")
    once, told = upsert.append_new(current, batch, ["k", "g"], [F.col("p")], "k")
    assert rows(told) == [(1, 1), (3, 1)]
    assert (1, "a", 3.0) in rows(once) and (1, None, 5.0) in rows(once)
    again, told = upsert.append_new(once, batch, ["k", "g"], [F.col("p")], "k")
    assert rows(told) == [] and rows(again) == rows(once)


def test_correction_window(spark):
    days = [date(2024, 1, d) for d in (1, 24, 25, 31)]
    current = spark.createDataFrame([(i, d, 1.0, i == 3) for i, d in enumerate(days)], "k int, d date, p double, private boolean")
    batch = spark.createDataFrame([(i, 2.0) for i in range(4)], "k int, p double")
    recent = F.col("d") >= F.date_sub(F.lit(date(2024, 1, 31)), 6)
    following, changed = upsert.correct_recent(current, batch, ["k"], ["p"], "p", recent, ~F.col("private"))
    assert rows(changed) == [(2, 1.0, 2.0)]
    assert [r.p for r in following.orderBy("k").collect()] == [1.0, 1.0, 2.0, 1.0]
    assert rows(upsert.correct_recent(following, batch, ["k"], ["p"], "p", recent, ~F.col("private"))[1]) == []


def test_upsert_outcomes_add_up(spark):
    current = spark.createDataFrame([("a", 1), ("b", 2), ("c", None)], "k string, v int")
    batch = spark.createDataFrame([("b", 3), ("c", None), ("d", 4)], "k string, v int")
    following, told = upsert.upsert(current, batch, ["k"], ["v"])
    assert rows(told) == [("b", "updated"), ("c", "unchanged"), ("d", "inserted")]
    assert rows(following) == [("a", 1), ("b", 3), ("c", None), ("d", 4)]
    assert {o for _, o in rows(upsert.upsert(following, batch, ["k"], ["v"])[1])} == {"unchanged"}


def test_absent_columns_and_links(spark):
    current = spark.createDataFrame([(1, "x", "y")], "k int, a string, b string")
    intended = spark.createDataFrame([(1, None, None, ["a"])], "k int, a string, b string, present array<string>")
    following, log = upsert.diff_rows(current, intended, "k", ["a", "b"], "present")
    assert rows(following) == [(1, None, "y")] and rows(log) == [(1, "a", "x", None)]
    links = spark.createDataFrame([(1, "u", datetime(2020, 1, 1)), (2, "v", datetime(2020, 1, 1))], "k int, x string, at timestamp")
    batch = spark.createDataFrame([(1, "u"), (2, "w"), (3, "z")], "k int, x string")
    now = F.lit(datetime(2021, 1, 1))
    assert [(r.k, r["at"].year) for r in upsert.upsert_links(links, batch, ["k"], ["x"], "at", now).orderBy("k").collect()] == [(1, 2020), (2, 2021), (3, 2021)]


def test_replaced_groups_keep_private_rows(spark):
    current = spark.createDataFrame([(1, "o", "s", True), (1, "o", "p", False), (2, "o", "t", True)], "k int, role string, sha string, shared boolean")
    batch = spark.createDataFrame([(1, "o", "n", True), (2, "o", "t", True)], "k int, role string, sha string, shared boolean")
    following, told = upsert.replace_groups(current, batch, ["k", "role"], F.col("shared"), ["sha"])
    assert rows(told) == [(1, "o", "replaced"), (2, "o", "unchanged")]
    assert {(r.k, r.sha) for r in following.collect()} == {(1, "p"), (1, "n"), (2, "t")}


def test_whole_groups_are_rejected(spark):
    df = spark.createDataFrame([("a", 1, 1), ("a", 2, 2), ("b", 1, 2), ("b", 2, 2), ("c", 1, None)], "g string, pos int, v int")
    good, bad = validate.strictly_increasing(df, ["g"], [F.col("pos")], "v")
    assert {r.g for r in good.collect()} == {"a"} and {r.g for r in bad.collect()} == {"b", "c"}
    reasons = validate.first_failure(df, ["g"], ["pos"], [("null", F.col("v").isNull()), ("two", F.col("v") == 2)])
    assert rows(reasons) == [("a", "two"), ("b", "two"), ("c", "null")]


def test_match_reports_conflicts_and_ignores_order(spark):
    cards = spark.createDataFrame([("c1", 2020, 5.0, None, "a"), ("c2", 2020, 5.0, None, "a b"), ("c3", 2021, 5.0, None, "z"), ("c4", 2020, 5.0, None, "q"), ("c5", 2020, 5.0, None, "q")], "card string, year int, value double, pack string, title string")
    listing = spark.createDataFrame([("r1", 2020, 5.0, None, "a"), ("r2", 2020, 5.0, None, "a b"), ("r3", 2020, 5.0, None, "z"), ("r4", 2020, 5.0, None, "q")], "row string, year int, value double, pack string, title string")
    want = {"c1": ("matched", "r1"), "c2": ("matched", "r2"), "c3": ("matched", "r3"), "c4": ("contested", None), "c5": ("contested", None)}
    for data in (cards, cards.orderBy(F.desc("card"))):
        assert {r.card: (r.status, r.row) for r in match.match(data, listing).collect()} == want
    declared = spark.createDataFrame([("r4", ["c5", "c4"])], "row string, members array<string>")
    assert {r.card: r.status for r in match.match(cards, listing, declared).collect()}["c4"] == "matched"
    partly = spark.createDataFrame([("r4", ["c4"])], "row string, members array<string>")
    assert {r.card: r.status for r in match.match(cards, listing, partly).collect()}["c4"] == "contested"


def test_titles_meet_by_equality(spark):
    titles = ["", " ", " a", "a", "a ", "a  b", "a b", "a b c", "ab", "b", None]
    cards, listing = (spark.createDataFrame([(i, 2020, 5.0, None, t) for i, t in enumerate(titles)], f"{n} int, year int, value double, pack string, title string") for n in ("card", "row"))
    found = match.candidates(cards, listing)
    pairs = cards.select("card", F.col("title").alias("a")).crossJoin(listing.select("row", F.col("title").alias("b"))).filter(match.titles_agree(F.col("a"), F.col("b")))
    assert rows(found) == rows(pairs.select("card", "row", (F.col("a") == F.col("b")).alias("exact")))
    # No pair of a year is compared title by title.
    assert "startswith" not in found._jdf.queryExecution().optimizedPlan().toString().lower()


def test_quality_suffix_decides(spark):
    found = spark.createDataFrame([("c", "r1", "Рік (пруф)", "пруф"), ("c", "r2", "Рік (звичайна)", "пруф"), ("d", "r3", "Рік (пруф)", "пруф"), ("d", "r4", "Інше (звичайна)", "пруф")], "card string, row string, title string, quality string")
    assert {r.row for r in match.prefer_quality(found, "title", "quality").collect()} == {"r1", "r3", "r4"}


def test_picks(spark):
    photos = spark.createDataFrame([("c", 1, None, False, 0.2), ("c", 2, "reverse", True, 0.9), ("c", 3, None, True, 0.5)], "card string, pos int, said string, ok boolean, score double")
    assert {(r.role, r.pos) for r in pick.roles(photos, "card", "pos", "said", F.col("ok"), F.col("score")).collect()} == {("obverse", 3), ("reverse", 2)}
    best = pick.pick_best(photos.withColumn("bad", F.lit(False)), ["card"], F.col("bad"), F.col("score"), F.col("pos"))
    assert [(r.pos, r.fallback) for r in best.orderBy("pick").collect()] == [(1, True), (2, True)]
    sizes = spark.createDataFrame([(250,), (305,), (700,), (None,)], "s int").select(pick.tiers(F.col("s")).alias("t")).collect()
    assert [r.t for r in sizes] == [[250], [300], [300, 600, 700], []]


def test_breaker_and_text(spark):
    df = spark.createDataFrame([("g", i, i in (1, 2, 4, 5, 6, 7)) for i in range(9)], "g string, i int, bad boolean")
    assert [r.i for r in report.until_breaker(df, ["g"], [F.col("i")], F.col("bad"), 3).orderBy("i").collect()] == [0, 1, 2, 3, 4, 5, 6]
    assert spark.range(1).select(report.first_some(F.transform(F.sequence(F.lit(1), F.lit(12)), lambda x: x.cast("string"))).alias("x")).first().x.endswith("10 (+2)")


def test_empty_scope_is_an_error(spark):
    import pytest

    with pytest.raises(ValueError):
        validate.need_some([], "series")
    with pytest.raises(ValueError):
        validate.need_columns(spark.range(1), ["id", "x"])


def test_slugs_never_collide(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "a"), (3, "a-2"), (4, "b"), (5, "b"), (6, "a"), (7, "a-2-2")], "pos int, base string")
    old = spark.createDataFrame([("b-2",), ("a-3",)], "slug string")
    found = {r.pos: r.slug for r in match.unique_slugs(rows, "base", "pos", existing=old).collect()}
    assert found == {1: "a", 2: "a-2", 3: "a-2-2", 4: "b", 5: "b-3", 6: "a-4", 7: "a-2-2-2"}


def test_merge_is_blocked_by_a_curated_name(spark):
    old = spark.createDataFrame([("x", "x", False), ("y", "y", True)], "name string, slug string, curated boolean")
    following, conflicts = match.merged_dictionary(spark.createDataFrame([("y",), ("z",)], "name string"), old, "name", F.col("name"))
    assert [r.name for r in conflicts.collect()] == ["y"] and sorted(tuple(r) for r in following.collect()) == [("x", "x", False, False), ("y", "y", True, False)]
    following, conflicts = match.merged_dictionary(spark.createDataFrame([("x y",), ("z",)], "name string"), old, "name", F.lit("x"))
    assert conflicts.isEmpty() and sorted(tuple(r) for r in following.collect()) == [("x", "x", False, True), ("x y", "x-2", False, False), ("y", "y", True, False), ("z", "x-3", False, False)]
