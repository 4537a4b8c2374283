import hashlib
import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

import __spark_entry__
from ledgerlark.plans import catalogue, fields, flows  # noqa: F401  the latter two register theirs


@pytest.mark.parametrize("name", sorted(catalogue.ORACLES))
def test_query_agrees_with_its_sql(spark, sf_dir, same_rows, name):
    same_rows(catalogue.QUERIES[name](spark, sf_dir), catalogue.ORACLES[name])


def test_entry_has_rows(spark):
    assert __spark_entry__.entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_greedy_pairs_follow_the_greedy_order(spark, sf_dir):
    scores = catalogue.QUERIES["overlap_scores"](spark, sf_dir).collect()
    a, b, want = set(), set(), set()
    for r in sorted(scores, key=lambda r: (-r.overlap, r.a, r.b)):
        if r.a not in a and r.b not in b:
            a.add(r.a)
            b.add(r.b)
            want.add((r.a, r.b, r.overlap))
    assert {tuple(r) for r in catalogue.QUERIES["overlap_pairs"](spark, sf_dir).select("a", "b", "overlap").collect()} == want


NESTED = "BroadcastNestedLoopJoin|CartesianProduct"


@pytest.mark.parametrize("name", ["candidate_match", "band_fallback", "idempotent_append", "replace_group"])
def test_joins_have_equality_keys(spark, sf_dir, name):
    plan = catalogue.QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_control_point_compares_values(spark, tmp_path):
    rows = [(1, 1, "view", 5.0), (1, 2, "view", 6.0), (2, 1, "view", 5.0), (2, 1, "error", 7.0), (3, 1, "view", 5.0), (3, 2, "error", 5.0), (4, 1, "error", 5.0)]
    rows += [(5, 1, "view", 5.0), (5, 1, "error", 4.0), (6, 1, "view", None)]
    events = spark.createDataFrame(rows, "user_id long, ts long, event_type string, value double").withColumn("ts", F.timestamp_seconds("ts"))
    events.write.parquet(f"{tmp_path}/events.parquet")
    found = dict(catalogue.QUERIES["control_point"](spark, str(tmp_path)).collect())
    # Without a printed price there is nothing to compare, whatever the points are.
    assert found == {1: "ok", 2: "mismatch", 3: "mismatch", 4: "no_points", 5: "ok", 6: "not_found"}


def whole_key(s: str) -> str:
    """The comparison key by hand: look-alikes letter by letter, apostrophes, letters, quotes, blanks, case."""
    latin, cyrillic = "iIaAeEoOpPcCxXyHBKMT", "іІаАеЕоОрРсСхХуНВКМТ"
    for a, b in zip(latin, cyrillic, strict=True):
        s = re.sub(f"(?<=[а-яА-ЯіІїЇєЄґҐ]){a}(?![a-zA-Z])|(?<![a-zA-Z]){a}(?=[а-яА-ЯіІїЇєЄґҐ])", b, s)
    marks = "'`’ʼ"
    s = "".join(c if c not in marks else "’" if s[i - 1 : i].isalpha() and s[i + 1 : i + 2].isalpha() else "" for i, c in enumerate(s))
    s = "".join(c for c in s.replace("ґ", "г").replace("Ґ", "Г") if c not in '«»"“”')
    return " ".join(re.split(r"\s+", s)).strip(" ").lower()


def test_match_key_is_brute_force(spark, sf_dir, tmp_path):
    # Equal but for look-alikes, apostrophes, letters and quotes; then one that differs.
    same = ["Пам'ятна монета «Ґрунт»", "Пaм’ятнa  мoнета Грунт", "пам`ятна монета\t\"Ґрунт\"'", "ПАМʼЯТНА MОНЕТА Грунт "]
    rows = [(i, t) for i, t in enumerate([*same, "Памятна монета Грунт", "coin of 'x' don't", "", None])]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    for folder in (sf_dir, str(tmp_path)):
        texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()}
        found = dict(catalogue.QUERIES["match_key"](spark, folder).collect())
        assert found == {i: None if t is None else hashlib.md5(whole_key(t).encode()).hexdigest() for i, t in texts.items()}
    assert len({found[i] for i in range(len(same))}) == 1 and found[len(same)] != found[0]


def test_a_place_in_a_history_has_one_fault(spark, tmp_path, duck):
    """A day given twice before a day that is unsound by itself, many small prices, and a day given twice alone."""
    odd = {(1, 3): (6, 3, 5.0), (1, 4): (1, 0, 0.5), (2, 3): (7, 3, 0.1), (3, 3): (6, 3, 5.0), (4, 3): (7, 3, 5.0)}
    rows = []
    for user in range(1, 6):
        for day in range(1, 25):
            n, bad, value = odd.get((user, day), (1, 0, 5.0))
            rows += [(user, datetime(2024, 1, day), "error" if i < bad else "view", value) for i in range(n)]
    spark.createDataFrame(rows, "user_id long, ts timestamp, event_type string, value double").write.parquet(f"{tmp_path}/events.parquet")
    found = catalogue.QUERIES["whole_histories"](spark, str(tmp_path)).collect()
    want = {1: ("positive", 3), 2: ("positive", 2), 3: ("order", 3), 4: ("size", 2), 5: (None, None)}
    assert {r.user_id: (r.reason, r.pos) for r in found} == want
    sql = f"WITH events AS (SELECT * FROM '{tmp_path}/events.parquet/*.parquet'), {catalogue.ORACLES['whole_histories'].split('WITH ', 1)[1]}"
    assert {r[0]: (r[1], r[2]) for r in duck.sql(sql).fetchall()} == want
