from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerlark.sources import fetching, landing, markup
from ledgerlark.streaming import microbatch

YEAR = """<table class="coin-list"><thead><tr><td>Назва</td><th>Вартість 08.09.2026</th></tr></thead>
<tr><td data-title="Назва"><a href="/ua/list/1999-abc" title="Різдво">x</a></td><td data-title="Номінал">5 (п'ять)</td><td class="ua-table-price-cell">7 568 <span>↑</span></td></tr>
<tr><td>1999</td></tr>
<tr><td data-title="Назва"><a href="/ua/list/7-b">Друга</a></td><td data-title="Номінал">2,5</td><td data-title="Вартість 08.09.2026">немає даних</td></tr></table>"""
CARD = """<div class="search-result"><div class="img-container"><a class="big-image" href="/b.jpg"><img src="/i/482.jpg"></a></div><div class="img-container"><img src="/i/482_r.jpg"></div>
<div class="title"> Назва  монети</div><p><span class="mark">Рік</span><span class="mark-text">2020</span></p>
<div class="description__text">a</div><div class="description__text"></div><div class="description__text">c</div></div><div class="search-result">без зображення</div>"""


def run(spark, html, rows, schema):
    return markup.extracted(spark.createDataFrame([(1, html), (2, None)], "id int, html string"), "id", "html", rows, schema).collect()


def test_year_table(spark):
    a, b = run(spark, YEAR, markup.year_rows, markup.YEAR_SCHEMA)
    assert (a.row_id, a.title, a.value, a.price, a.as_of) == (1999, "Різдво", 5.0, Decimal(7568), date(2026, 9, 8))
    assert (b.row_id, b.title, b.value, b.price) == (7, "Друга", 2.5, None)
    (bad,) = run(spark, YEAR.replace("08.09.2026", "скоро"), markup.year_rows, markup.YEAR_SCHEMA)
    assert bad.anomaly and bad.row_id is None
    assert run(spark, "<p>no table</p>", markup.year_rows, markup.YEAR_SCHEMA) == []


def test_cards(spark):
    a, b = run(spark, CARD, markup.cards, markup.CARD_SCHEMA)
    assert (a.card_id, a.title, a.marks, a.descriptions) == ("482", "Назва монети", {"Рік": "2020"}, ["a", "", "c"])
    assert a.big_images == ["/b.jpg", None] and b.card_id is None


def test_endpoints_in_any_escaping(spark):
    html = r'<a href="/coin/prices/5">x</a><div data-x="{&quot;u&quot;:&quot;\/coin\/prices\/9?_h=1&amp;e=2&quot;}"><script>"\/coin\/prices\/9"</script>'
    df = markup.extracted(spark.createDataFrame([(1, html)], "id int, html string"), "id", "html", markup.endpoints, markup.ENDPOINT_SCHEMA)
    assert markup.chosen_endpoint(df, "id", F.lit(9)).first().path == "/coin/prices/9?_h=1&e=2"
    assert markup.chosen_endpoint(df, "id", F.lit(5)).first().signed is False
    assert markup.chosen_endpoint(df, "id", F.lit(77)).first().signed is True


def test_prices(spark):
    note = '<body><h1>5 грн., 1999</h1><p class="coin-price-note__text">станом на 08.09.2026 — 1 568 грн</p></body>'
    (r,) = run(spark, note, markup.current_prices, markup.PRICE_SCHEMA)
    assert (r.price, r.day, r.found_by) == (Decimal(1568), date(2026, 9, 8), "note")
    (r,) = run(spark, "<body><div><h1>5 грн</h1></div><p>на 01.02.2020: 30 грн</p></body>", markup.current_prices, markup.PRICE_SCHEMA)
    assert (r.price, r.found_by) == (Decimal(30), "scan")
    widget = '<div class="market-pending"><b class="market-pending__price">2 345 грн</b><i class="market-pending__price-label">від 03.04.2024</i></div>'
    (r,) = run(spark, widget, markup.issue_prices, markup.PRICE_SCHEMA)
    assert (r.price, r.day) == (Decimal(2345), date(2024, 4, 3))
    assert run(spark, "<h1>5 грн</h1>", markup.issue_prices, markup.PRICE_SCHEMA) == []


def test_landed_bodies(spark, tmp_path):
    bodies = spark.createDataFrame([("a", '[{"date":"2024-01-01","price":5},{"date":"x","price":true}]'), ("b", "{}"), ("c", None)], "k string, body string")
    found = {(r.k, r.pos): (r.day, r.price, r.is_list) for r in landing.points(bodies, "k").collect()}
    assert found[("a", 0)] == (date(2024, 1, 1), Decimal(5), True) and found[("a", 1)] == (None, None, True)
    assert found[("b", None)][2] is False and found[("c", None)][2] is False
    rates = spark.createDataFrame([('[{"exchangedate":"05.01.2024","cc":"USD","rate_per_unit":27.123456},{"exchangedate":"05.01.2024","cc":"EUR","rate_per_unit":1}]',)], "body string")
    assert [tuple(r) for r in landing.rates(rates, "USD").collect()] == [("USD", date(2024, 1, 5), Decimal("27.123456"))]
    (tmp_path / "_shared").mkdir()
    (tmp_path / "_shared" / "2020.html").write_text(YEAR)
    page = landing.pages(spark, f"{tmp_path}/_shared/*.html").select(landing.year_of(F.col("path")).alias("y"), "html").first()
    assert page.y == 2020 and page.html == YEAR
    days = spark.createDataFrame([("2024-01-01",), ("2024-01-18",), ("_keep",)], "name string")
    assert [r.name for r in landing.expired(days, "2024-01-31").collect()] == ["2024-01-01"]
    meta, now = spark.createDataFrame([("a", 1), ("b", 2)], "k string, m int"), spark.createDataFrame([("a", 1), ("b", 3), ("c", 4)], "k string, n int")
    assert {r.k for r in landing.stale(meta, now, "k", "m", "n").collect()} == {"b", "c"}


def test_retry_policy():
    pauses, answers = [], [fetching.Response(429, "", 7.0), fetching.Response(429, ""), OSError(), fetching.Response(200, "ok")]

    def get(url):
        r = answers.pop(0)
        if isinstance(r, OSError):
            raise r
        return r

    assert fetching.fetched(get, "u", pauses.append) == "ok" and pauses == [7.0, 30.0, 3.0]
    assert fetching.fetched(lambda u: fetching.Response(404, "x"), "u") == ""
    with pytest.raises(RuntimeError):
        fetching.fetched(lambda u: fetching.Response(429, ""), "u", pauses.append)
    assert len(fetching.all_pages(lambda n: "<b>" * (2 if n < 3 else 1), "<b>", 2)) == 3


def test_stream_upsert_replays_as_no_op(spark, tmp_path):
    folder, state = tmp_path / "in", {"table": spark.createDataFrame([(1, date(2024, 1, 1), 5.0), (2, date(2024, 1, 30), 5.0)], "k int, d date, p double")}
    spark.createDataFrame([(1, date(2024, 1, 1), 6.0), (2, date(2024, 1, 30), 6.0), (3, date(2023, 1, 1), 7.0)], "k int, d date, p double").coalesce(1).write.parquet(str(folder))
    stores = []

    def store(df):
        path = str(tmp_path / f"v{len(stores)}")
        df.write.parquet(path)
        stores.append(path)
        state["table"] = spark.read.parquet(path)

    for turn in ("one", "two", "one"):
        stream = microbatch.file_stream(spark, str(folder), "k int, d date, p double")
        microbatch.upsert_stream(stream, lambda: state["table"], store, str(tmp_path / turn), ["k"], [F.col("p")], ["p"], "p", "d", F.lit(date(2024, 1, 31))).awaitTermination()
        assert sorted(tuple(r) for r in state["table"].select("k", "p").collect()) == [(1, 5.0), (2, 6.0), (3, 7.0)]
    assert len(stores) == 2


def test_sinks(spark, tmp_path):
    path = landing.write_snapshot(spark.range(3), str(tmp_path), "t", 1)
    assert spark.read.parquet(path).count() == 3
    landing.write_side(spark.range(2), str(tmp_path), "anomalies", "r1")
    assert spark.read.json(str(tmp_path / "anomalies" / "run=r1")).count() == 2
