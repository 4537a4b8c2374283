"""Whole loads, dictionaries, slugs and streams: the rules' own cases, and brute force."""

import random
import re
import unicodedata
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerlark.functions import text, values
from ledgerlark.operators import cards, match, numbering, pick, upsert, validate
from ledgerlark.sources import fetching, landing, markup
from ledgerlark.streaming import microbatch, tables


def column(spark, function, given):
    df = spark.createDataFrame(list(enumerate(given)), "i int, s string")
    return [r.x for r in df.select("i", function(F.col("s")).alias("x")).orderBy("i").collect()]


# ---- fields -------------------------------------------------------------------------------------------


def test_fields_by_their_rules(spark):
    assert column(spark, values.grouped_decimal, ["7 568", "1 234,50", "1 234", "1 234", "x"]) == [Decimal("7568"), Decimal("1234.50"), Decimal("1234"), None, None]
    faces = column(spark, values.face_value, ["5 гривень", "5грн", "~5 грн", "2,5  a b ", "x", "10", "", None])
    assert [tuple(f) for f in faces] == [(5.0, "гривень"), (5.0, None), (5.0, "грн"), (2.5, "a b "), (None, None), (10.0, None), (None, None), (None, None)]
    assert column(spark, values.dotted_date, ["8.9.2026", "08.09.2026", " 01.02.2020 ", "31.02.2020", "2020-01-01", "1.1.20", "01.01.2020x"]) == [date(2026, 9, 8), date(2026, 9, 8), None, None, None, None, None]
    assert column(spark, values.date_in_text, ["03-04-2024", "на 03/04/2024.", "12024-02-03", "2024-13-01 03.04.2024", "1.1.2020", "x2024-01-01"]) == [date(2024, 4, 3), date(2024, 4, 3), None, None, None, None]
    assert column(spark, text.names, ["Дан" + chr(0x69) + "ло Іванов, B;", "", None]) == [["Даніло Іванов", "B"], [], []]


def test_iso_dates_are_the_standard_s(spark):
    given = [f"{y}-W{w:02}-{d}" for y in (2015, 2020, 2021, 2024) for w in (0, 1, 52, 53, 54) for d in (1, 7)] + ["2024W053", "2024-W05", "20240131", "2024-01-31", "2024-02-30", "0000-01-01", "2024-1-1", "2024-01-31T00", "24.11.2023"]

    def standard(s):
        try:
            return date.fromisoformat(s)
        except ValueError:
            return None

    assert column(spark, values.iso_date, given) == [standard(s) for s in given]


def test_homoglyphs_in_one_pass_are_those_letter_by_letter(spark):
    rnd = random.Random(3)
    given = ["".join(rnd.choice("iIoHMквдґ z1-") for _ in range(rnd.randint(0, 12))) for _ in range(400)]

    def plain(s):
        for a, b in zip(text.LATIN_LOOKALIKES, text.CYRILLIC_LETTERS, strict=True):
            s = re.sub(f"(?<=[{text.CYRILLIC}]){a}(?![a-zA-Z])|(?<![a-zA-Z]){a}(?=[{text.CYRILLIC}])", b, s)
        return s

    assert column(spark, text.fix_homoglyphs, given) == [plain(s) for s in given]


def test_slugs_of_all_characters(spark):
    """Every code point beside letters. Characters that the two runtimes' tables know apart are left out."""
    known = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000 and unicodedata.category(chr(c)) != "Cn"]
    df = spark.createDataFrame([(i, f"x{c}y") for i, c in enumerate(known)], "i int, s string").select("i", text.slug(F.col("s")).alias("x"), F.lower("s").alias("low"))
    table = {**text.TRANSLITERATION, **dict(zip(text.TRANSLITERATION_FROM, text.TRANSLITERATION_TO, strict=True))}
    wrong = []
    for r in df.collect():
        s = f"x{known[r.i]}y".lower()
        ascii_only = unicodedata.normalize("NFKD", "".join(table.get(c, c) for c in s)).encode("ascii", "ignore").decode()
        if r.low == s and r.x != (re.sub("[^a-z0-9]+", "-", ascii_only).strip("-") or "series"):
            wrong.append((known[r.i], r.x))
    assert not wrong and len(known) > 200_000
    assert column(spark, text.slug, ["½ ﬁ Å", "Об'єкт №5", "!!", None]) == ["12-fi-a", "obiekt-o5", "series", "series"]


def test_gallery_takes_its_own_links_alone():
    html = '<a data-fancybox="coin-media" href="/b.jpg" data-caption="c"><img src="/m.jpg"></a><a data-fancybox="similar" href="/x.jpg"></a><a data-fancybox="coin-media"><img alt="y"></a><a data-fancybox="coin-media" href="/z.jpg"><img src="" alt="a"></a>'
    assert list(markup.gallery(html)) == [{"big": "/b.jpg", "middle": "/m.jpg", "alt": "c"}, {"big": "/z.jpg", "middle": "", "alt": "a"}]


def test_short_dates_count_in_a_sentence_alone():
    assert [d.day for d in markup.dates("1.2.2020 01.02.2020 x03.04.2020")] == [date(2020, 2, 1)]
    assert markup.sentence_price("станом на 1.2.2020: 5 грн") == (None, Decimal(5))


# ---- histories ----------------------------------------------------------------------------------------

BODIES = {
    "sound": ('[{"date":"2023-11-24","price":481},{"date":" 2023-11-25\\t","price":480.5},{"date":"2024-01-31","price":"7 568,50"}]', None),
    "gaps": ('[{"date":"2023-11-24","price":520},{"date":"2023-12-18","price":650},{"date":"2023-12-19","price":520}]', None),
    "tiny": ('[{"date":"2024-01-01","price":1e-9}]', None),
    "empty": ("[]", None),
    "backwards": ('[{"date":"2024-01-02","price":10},{"date":"2024-01-01","price":11}]', ("order", 1)),
    "twice": ('[{"date":"2024-01-01","price":10},{"date":" 2024-01-01","price":11}]', ("order", 1)),
    "day before price": ('[{"date":"2024-01-02","price":10},{"date":"2024-01-01","price":true}]', ("order", 1)),
    "date": ('[{"date":"24.11.2023","price":481}]', ("date", 0)),
    "zero": ('[{"date":"2024-01-01","price":1},{"date":"2024-01-02","price":0}]', ("positive", 1)),
    "negative": ('[{"date":"2024-01-01","price":-1e40}]', ("positive", 0)),
    "null": ('[{"date":"2024-01-01","price":null}]', ("number", 0)),
    "word": ('[{"date":"2024-01-01","price":"x"}]', ("number", 0)),
    "list price": ('[{"date":"2024-01-01","price":[1]}]', ("number", 0)),
    "boolean": ('[{"date":"2024-01-01","price":true}]', ("boolean", 0)),
    "quoted boolean": ('[{"date":"2024-01-01","price":"true"}]', ("number", 0)),
    "large": ('[{"date":"2024-01-01","price":10000000000000}]', ("size", 0)),
    "bound": ('[{"date":"2024-01-01","price":1000000000000}]', ("size", 0)),
    "huge": ('[{"date":"2024-01-01","price":1e300}]', ("size", 0)),
    "object": ('{"error":"expired"}', ("list", None)),
    "nothing": ("null", ("list", None)),
    "cut": ('[{"date":"2024-01-01"', ("json", None)),
    "missing": (None, ("json", None)),
    "plain point": ("[1]", ("object", 0)),
    "no price": ('[{"date":"2024-01-01"}]', ("keys", 0)),
    "null date": ('[{"date":null,"price":1}]', ("date type", 0)),
    "number date": ('[{"date":20240101,"price":1}]', ("date type", 0)),
}


def test_histories_are_rejected_whole(spark):
    points, rejected = landing.histories(spark.createDataFrame([(k, b) for k, (b, _) in BODIES.items()], "k string, body string"), "k")
    assert {r.k: (r.reason, r["at"]) for r in rejected.collect()} == {k: want for k, (_, want) in BODIES.items() if want}
    found = points.collect()
    assert {r.k for r in found} == {"sound", "gaps", "tiny"} and len(found) == 7
    assert {(r.pos, r.day, r.price) for r in found if r.k == "sound"} == {(0, date(2023, 11, 24), Decimal(481)), (1, date(2023, 11, 25), Decimal("480.5")), (2, date(2024, 1, 31), Decimal("7568.5"))}
    assert "Exchange" not in points._jdf.queryExecution().executedPlan().toString()


# ---- control point, cards, qualities ------------------------------------------------------------------


def test_control_points(spark):
    points = spark.createDataFrame([(i, date(2024, 1, 2), 5.0) for i in (1, 2, 3, 4, 7)], "k int, last_day date, last_value double")
    printed = spark.createDataFrame([(1, date(2024, 1, 2), 5.0), (2, None, 5.0), (3, None, 6.0), (4, date(2024, 1, 1), 5.0), (5, date(2024, 1, 2), 5.0), (6, None, None), (7, None, None)], "k int, printed_day date, printed_value double")
    found = {r.k: r.status for r in pick.control_point(points, printed, ["k"]).collect()}
    assert found == {1: "ok", 2: "ok", 3: "mismatch", 4: "mismatch", 5: "no_points", 6: "not_found", 7: "not_found"}


def test_a_card_s_own_source_of_its_title_holds(spark):
    schema = "source_id string, titles struct<uk:string,en:string>, year int, material string, edge string, quality string, circulation_date date, mintage struct<announced:long,actual:long>, weight_grams double, fine_weight_grams double, diameter_mm double, description string, artists struct<designers:array<string>,sculptors:array<string>>, title_en_source string"
    rows = [(f"nb:{i}", ("а", en), 2020, None, None, None, None, (None, 0), None, 1.5, None, None, ([], []), said) for i, (en, said) in enumerate([("a", "manual"), ("b", None), (None, "manual")])]
    told, _ = cards.item_values(spark.createDataFrame(rows, schema).withColumns({"s": F.lit(1), "d": F.lit(2)}), "s", "d")
    assert [(r.title_en_source, "title_en_source" in r.present) for r in told.orderBy("source_key").collect()] == [("manual", True), ("official", True), (None, False)]


def test_qualities_are_compared_by_key(spark):
    rows = [("a", 1, "Рік (proof)", "«Proof»"), ("a", 2, "Рік (звичайна)", "«Proof»"), ("b", 3, "Рік (proof)", ""), ("b", 4, "Рік (звичайна)", ""), ("c", 5, "Рік (Пpуф)", "пруф"), ("c", 6, "Рік (інша)", "пруф")]
    found = spark.createDataFrame(rows, "card string, row int, title string, quality string")
    assert {r.row for r in match.prefer_quality(found, "title", "quality").collect()} == {1, 3, 4, 5}


# ---- dictionaries -------------------------------------------------------------------------------------

OLD = "name string, slug string, curated boolean, n int"


def merged(spark, fresh, old):
    following, conflicts = match.merged_dictionary(spark.createDataFrame(fresh, "name string, n int"), spark.createDataFrame(old, OLD), "name", text.slug(F.col("name")))
    return [tuple(r) for r in following.collect()], [tuple(r) for r in conflicts.collect()]


def test_merge_keeps_slugs_by_comparison_key_and_takes_fresh_content(spark):
    assert merged(spark, [("Античні пам’ятки України", 2), ("«Hазва»", 3)], [("Античні пам`ятки України", "old-stable-slug", False, 1), ("Назва", "x", False, 1)]) == ([("Античні пам’ятки України", "old-stable-slug", False, False, 2), ("«Hазва»", "x", False, False, 3)], [])


def test_merge_prefers_official_entries_to_curated_ones(spark):
    following, conflicts = merged(spark, [("Назва", 5)], [("Назва", "official", False, 1), ("назва", "by-hand", True, 7)])
    assert (following, conflicts) == ([("назва", "by-hand", True, False, 7), ("Назва", "official", False, False, 5)], [])


def test_merge_flags_what_vanished_and_sorts_by_slug(spark):
    following, conflicts = merged(spark, [("Я Остання", 1), ("А Перша", 1)], [("Зникла", "gone", False, 3), ("Кураторська", "by-hand", True, 4)])
    assert not conflicts and [r[1] for r in following] == sorted(r[1] for r in following)
    assert ("Зникла", "gone", False, True, 3) in following and ("Кураторська", "by-hand", True, False, 4) in following and ("А Перша", "a-persha", False, False, 1) in following


def test_merge_stops_at_a_curated_name(spark):
    old = [("Ми сильні. Ми разом.", "by-hand", True, 4), ("Інше", "other", False, 1)]
    following, conflicts = merged(spark, [("Ми сильні.  Ми разом.", 25), ("Нове", 1)], old)
    assert conflicts == [("Ми сильні.  Ми разом.", "by-hand")] and following == [(n, s, c, False, k) for n, s, c, k in old]
    assert merged(spark, [], []) == ([], [])


def test_chains_tell_the_step_that_failed(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (4, None)], "id int, name string")
    names, ids = spark.createDataFrame([("a", "s-a"), ("b", "s-b"), ("a", "s-z")], "n string, s string"), spark.createDataFrame([("s-a", 7)], "s string, i int")
    good, bad = match.resolve_chain(rows, "name", [("name", names, F.col("n"), F.col("s")), ("slug", ids, F.col("s"), F.col("i"))], "to")
    assert [tuple(r) for r in good.collect()] == [(1, "a", 7)]
    assert {tuple(r) for r in bad.collect()} == {(2, "b", "slug", "s-b"), (3, "c", "name", "c"), (4, None, "name", None)}


def test_sync_groups_and_warns(spark):
    listed = spark.createDataFrame([(1, "t1", "Назва"), (2, "t2", "«Hазва»"), (3, "t3", "Інша"), (None, "Відома", "x"), (None, "Нова", "x"), (None, "", "x")], "id int, title string, series string")
    titles = spark.createDataFrame([("відома", None), (None, "y")], "a string, b string")
    names = spark.createDataFrame([("назва", 9)], "k string, i int")
    found = match.synced(listed, spark.createDataFrame([(1,)], "id int"), "id", "title", "series", titles, [("name", names, F.col("k"), F.col("i"))])
    assert {tuple(r) for r in found.collect()} == {("group", "9", 2, "t2"), ("name", "інша", 3, "t3"), ("no id", None, None, "Нова")}


def test_dictionary_upsert(spark):
    current = spark.createDataFrame([(1, "a", "x"), (2, "b", "y"), (5, "own", "z")], "id int, name string, kind string")
    ids = spark.createDataFrame([("a", 1), ("b", 2), ("lost", 9)], "slug string, id int")
    entries = [("a", "A", None, False, ["name"]), ("b", "b", "y", False, ["name", "kind"]), ("lost", "l", "l", False, ["name"]), ("v", "v", "v", True, ["name"]), ("z", "Z", "k", None, ["name", "kind"]), ("new", "N", "no", False, ["name"])]
    given = spark.createDataFrame(entries, "slug string, name string, kind string, gone boolean, present array<string>")
    for parts in (1, 5):
        following, known, report = upsert.upsert_dictionary(current, ids, given.repartition(parts), "slug", "id", ["name", "kind"], "gone", "present")
        assert {tuple(r) for r in following.collect()} == {(1, "A", "x"), (2, "b", "y"), (5, "own", "z"), (10, "N", None), (11, "Z", "k")}
        assert {tuple(r) for r in known.collect()} == {("a", 1), ("b", 2), ("lost", 9), ("new", 10), ("z", 11)}
        assert {r.slug: (r.action, [c.col for c in r.changes]) for r in report.collect()} == {"a": ("update", ["name"]), "b": ("unchanged", []), "lost": ("lost", []), "v": ("skip", []), "z": ("insert", ["name", "kind"]), "new": ("insert", ["name"])}


def test_created_keys_have_computed_columns(spark):
    old = spark.createDataFrame([("uah", 5.0, 4, 500)], "unit string, value double, id int, sort int")
    rows = spark.createDataFrame([("uah", 5.0), ("uah", 0.5), ("kop", 2.0), ("kop", 2.0), (None, 1.0)], "unit string, value double")
    got = upsert.get_or_create(old, rows, ["unit", "value"], "id", {"sort": (F.col("value") * 100).cast("int")})
    assert {tuple(r) for r in got.collect()} == {("uah", 5.0, 4, 500), ("kop", 2.0, 5, 200), ("uah", 0.5, 6, 50)}


# ---- slugs, numbers, scopes, picks --------------------------------------------------------------------


def plain_slugs(rows, old):
    taken, out = set(old), {}
    for pos, base in sorted(rows):
        name, n = base, 2
        while base is not None and name in taken:
            name, n = f"{base}-{n}", n + 1
        taken.add(name)
        out[pos] = name
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_slugs_are_those_of_going_row_by_row(spark, seed):
    rnd = random.Random(seed)
    pool = ["a", "a-2", "a-3", "a-2-2", "a-2-3", "b", "b-02", "b-1", "a-2-2-2", "c-2", "a-4", None]
    rows = [(i, rnd.choice(pool)) for i in range(90)]
    old = ["a", "a-5", "a-2-2", "b-3", "c-2-2", "a-17"] if seed == 1 else []
    found = match.unique_slugs(spark.createDataFrame(rows, "pos int, base string"), "base", "pos", existing=spark.createDataFrame([(s,) for s in old], "s string") if old else None)
    assert {r.pos: r.slug for r in found.collect()} == plain_slugs(rows, old)


def test_one_base_of_many_rows_is_spread(spark):
    rows = spark.range(20000).select(F.col("id").alias("pos"), F.lit("s").alias("base"))
    found = match.unique_slugs(rows, "base", "pos", existing=spark.createDataFrame([("s",), ("s-2",), ("s-10000",)], "s string"))
    r = found.agg(F.count_distinct("slug"), F.max(F.substring_index("slug", "-", -1).cast("int")), F.count_if(F.col("slug").isin("s", "s-2", "s-10000"))).first()
    assert tuple(r) == (20000, 20003, 0)
    parts = numbering.numbered(rows.repartition(4), ["base"], ["pos"], "k")
    assert parts.filter("k <> pos + 1").count() == 0


def test_small_scopes_are_pushed_down(spark, tmp_path):
    spark.range(100).select("id", (F.col("id") % 7).alias("k")).write.parquet(f"{tmp_path}/t")
    table, keys = spark.read.parquet(f"{tmp_path}/t"), spark.range(3).withColumnRenamed("id", "key")
    few, many = (validate.scoped(table, "k", keys, "key", most) for most in (3, 2))
    plans = [df._jdf.queryExecution().executedPlan().toString() for df in (few, many)]
    assert "In(k, [" in plans[0] and "Join" not in plans[0] and "LeftSemi" in plans[1]
    assert few.count() == many.count() == 44
    with pytest.raises(ValueError):
        validate.scoped(table, "k", keys.filter("key > 9"), "key")


def test_largest_and_newest(spark):
    rows = [("a", 1, 2, 3), ("a", 2, 3, 2), ("a", 3, 1, 1), ("b", 1, None, 2), ("b", 2, 1, None), ("c", 9, 1, None), ("c", 10, 1, 1)]
    df = spark.createDataFrame(rows, "g string, pos int, w int, h int")
    assert {(r.g, r.pos) for r in pick.largest(df, ["g"], F.col("w"), F.col("h"), "pos").collect()} == {("a", 1), ("b", 1), ("c", 10)}
    ids = spark.createDataFrame([(f"nb:{i}",) for i in (9, 10, 100, 2)] + [("x",)], "s string")
    assert [r.s for r in pick.newest(ids, text.id_number(F.col("s")), 2, ["s"]).collect()] == ["nb:100", "nb:10"]


# ---- streams ------------------------------------------------------------------------------------------


def keyed(spark, root):
    schema = spark.createDataFrame([], "k int, d date, v double").schema
    return tables.KeyedTable(spark, f"{root}/t", schema, ["k"], "v", "d", ["v"])


def test_a_batch_that_runs_again_changes_nothing(spark, tmp_path):
    table, day = keyed(spark, tmp_path), lambda n: date(2024, 1, n)
    one = spark.createDataFrame([(1, day(1), 1.0), (2, day(20), 2.0), (2, day(20), 1.0), (None, day(20), 3.0)], "k int, d date, v double")
    two = spark.createDataFrame([(1, day(1), 9.0), (2, day(20), 9.0), (3, day(2), 9.0), (None, day(20), 3.0)], "k int, d date, v double")
    table.merge(one, "w", 0)
    want = [(1, day(1), 1.0), (2, day(20), 9.0), (3, day(2), 9.0), (None, day(20), 3.0)]
    table.merge(two, "w", 1)
    for _ in range(2):
        assert sorted(map(tuple, table.read().collect()), key=repr) == sorted(want, key=repr)
        table.merge(two, "w", 1)
    # Cut off after the snapshot, before its outcome: told from the snapshot. Cut off within the snapshot: done again from the one below.
    tables.Folders(spark, f"{tmp_path}/t/outcomes/writer=w").drop("batch=1")
    table.merge(two, "w", 1)
    (tmp_path / "t/snapshots" / table.at(table.versions()[-1]).rsplit("/", 1)[1] / "_SUCCESS").unlink()
    tables.Folders(spark, f"{tmp_path}/t/outcomes/writer=w").drop("batch=1")
    table.merge(two, "w", 1)
    assert sorted(map(tuple, table.read().collect()), key=repr) == sorted(want, key=repr)
    assert {(r.batch, r.outcome): r.n for r in table.outcomes().collect()} == {(0, "inserted"): 3, (1, "corrected"): 1, (1, "repeated"): 2, (1, "inserted"): 1}
    table.merge(one.limit(0), "other", 0)
    assert len(table.versions()) == 2 and table.read().count() == 4


def test_a_batch_rewrites_the_parts_that_it_touches(spark, tmp_path):
    schema = spark.createDataFrame([], "k int, d date, v double").schema
    table = tables.KeyedTable(spark, f"{tmp_path}/t", schema, ["k", "d"], "v", "d", ["v"], part=lambda: F.date_format("d", "yyyy/MM"))
    rows = lambda *r: spark.createDataFrame([(k, date(2024, m, d), v) for k, m, d, v in r], schema)
    table.merge(rows((1, 1, 30, 1.0), (1, 2, 3, 1.0), (2, 3, 1, 1.0)), "w", 0)
    first = table.parts(table.versions()[-1])[0]
    table.merge(rows((1, 1, 30, 9.0), (2, 3, 1, 9.0), (3, 3, 2, 3.0)), "w", 1)
    second = table.parts(table.versions()[-1])[0]
    assert set(first) == {"2024/01", "2024/02", "2024/03"} and {p for p in first if first[p] != second[p]} == {"2024/01", "2024/03"}
    want = {(1, date(2024, 1, 30), 1.0), (1, date(2024, 2, 3), 1.0), (2, date(2024, 3, 1), 9.0), (3, date(2024, 3, 2), 3.0)}
    assert set(map(tuple, table.read().collect())) == want
    assert set(map(tuple, table.read(table.versions()[0]).collect())) == {(1, date(2024, 1, 30), 1.0), (1, date(2024, 2, 3), 1.0), (2, date(2024, 3, 1), 1.0)}
    for n in (2, 3):
        table.merge(rows((9, 5, n, 1.0)), "w", n)
    assert len(table.read().collect()) == 6 and want < set(map(tuple, table.read().collect()))
    kept = {p.name for p in (tmp_path / "t/data").glob("*/__part=*")}
    assert len([p for p in (tmp_path / "t/data").glob("*/__part=*") if "2024%2F03" in p.name]) == 1 and len(kept) == 4


def test_late_rows_are_set_aside(spark, tmp_path):
    def run(*hours):
        rows = [(datetime(2024, 1, 1, h), "x") if h is not None else (None, "x") for h in hours]
        spark.createDataFrame(rows, "ts timestamp, kind string").write.mode("append").parquet(f"{tmp_path}/in")
        stream = microbatch.file_stream(spark, f"{tmp_path}/in", "ts timestamp, kind string")
        tables.split_late(stream, str(tmp_path), "ts", "1 hour", "2 hours", f"{tmp_path}/c").awaitTermination()
        ontime = microbatch.file_stream(spark, f"{tmp_path}/ontime/batch=*", "ts timestamp, kind string")
        tables.windowed_counts(ontime, "ts", ["kind"], "1 hour", "2 hours", microbatch.by_batch(f"{tmp_path}/counts"), f"{tmp_path}/s").awaitTermination()

    run(5, 5, 10)
    run(7, 8, 12, None)
    run(8, 9, 10, 11)
    late = sorted((r.ts.hour if r.ts else -1) for r in spark.read.parquet(f"{tmp_path}/late/batch=*").collect())
    assert late == [-1, 7, 8, 9]  # windows end at 8 and 9 and 10, behind 8 and 10 o'clock
    counts = spark.read.parquet(f"{tmp_path}/counts").groupBy(F.hour("start").alias("h")).agg(F.max("n").alias("n")).collect()
    assert {r.h: r.n for r in counts} == {5: 2, 8: 1, 10: 2, 11: 1, 12: 1}


class Site:
    def __init__(self, counts):
        self.counts, self.asked = counts, 0

    def page(self, locale, query, number):
        self.asked += 1
        n = min(max(self.counts.get((locale, query), 0) - (number - 1) * 10, 0), 10)
        return fetching.Response(200 if n else 404, "".join(f"<article>{(number - 1) * 10 + i}" for i in range(n)))


@pytest.mark.parametrize("n", [0, 5, 10, 11, 95, 100, 101, 1234])
def test_a_listing_gives_each_block_once_and_goes_on(n):
    site = Site({("uk", "п’ять"): n, ("en", "п'ять"): 3})
    reader = fetching.ListingReader({"locales": "uk,en", "query": "п'ять", "per_page": "10", "pages_per_task": "7"}, site.page)
    start, end = reader.initialOffset(), reader.latestOffset()
    assert end == {"uk": [2 if n else 0, n // 10, n % 10], "en": [0, 0, 3]} and site.asked < 40
    read = lambda a, b: [(r[0], r[4].removeprefix("<article>")) for p in reader.partitions(a, b) for r in reader.read(p)]
    first = read(start, end)
    assert sorted(first) == sorted([("uk", str(i)) for i in range(n)] + [("en", str(i)) for i in range(3)])
    site.counts["uk", "п’ять"] = n + 25
    again = reader.latestOffset()
    assert read(start, end) == first  # a batch that runs again after the listing has grown
    assert sorted(read(end, again)) == sorted(("uk", str(i)) for i in range(n, n + 25)) and read(again, again) == []


def test_white_space_is_unicode_s(spark):
    rnd = random.Random(4)
    spaces = [chr(c) for c in range(0x3001) if chr(c).isspace() and not 0x1C <= c <= 0x1F]
    given = ["".join(rnd.choice([*spaces, *"   ab\x1c"]) for _ in range(rnd.randint(0, 9))) for _ in range(300)] + spaces
    assert column(spark, text.collapse, given) == [re.sub(f"[{''.join(spaces)}]+", " ", s).strip(" ") for s in given]
