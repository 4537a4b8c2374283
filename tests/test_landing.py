"""Landed files, runs, links and whole loads on small cases."""

import json
import struct
import zlib
from datetime import date

import pytest
from pyspark.sql import functions as F

from ledgerlark.operators import cards, loading, match, report, validate
from ledgerlark.plans import streams
from ledgerlark.sources import landing, markup
from ledgerlark.streaming import tables


def png(width: int, height: int) -> bytes:
    def chunk(kind: bytes, data: bytes) -> bytes:
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

    rows = b"".join(b"\0" + b"\x10\x20\x30" * width for _ in range(height))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(rows)) + chunk(b"IEND", b"")


def test_unreadable_images_are_rejected_rows(spark, tmp_path):
    (tmp_path / "a.png").write_bytes(png(3, 2))
    (tmp_path / "b.png").write_bytes(b"no image")
    found = {r.origin.rsplit("/", 1)[1]: (r.readable, r.width, r.height) for r in landing.images(spark, str(tmp_path)).collect()}
    assert found["a.png"] == (True, 3, 2) and found["b.png"][0] is False


def test_series_are_folders_without_an_underscore(spark, tmp_path):
    card = lambda i, ua: {"source_id": f"nb:{i}", "listing": ua and {"id": ua, "url": "/u"}}
    bodies = [("site/а b/parsed/cards.json", [card(1, 7), card(2, None)]), ("site/_cache/parsed/cards.json", [card(3, 9)]), ("site/s-b/parsed/cards.json", [card(4, 8)])]
    landing.write_named(spark.createDataFrame([(n, json.dumps({"cards": c}, ensure_ascii=False)) for n, c in bodies], "name string, body string"), "name", "body", str(tmp_path))
    every = landing.series_cards(spark, f"{tmp_path}/site").collect()
    assert {r.source_id for r in every} == {"nb:1", "nb:2", "nb:4"} and {r.series for r in every if r.source_id == "nb:4"} == {"s-b"}
    assert {r.source_id: r.listing and r.listing.id for r in every}["nb:2"] is None
    assert [r.source_id for r in landing.series_cards(spark, f"{tmp_path}/site", "s-b").collect()] == ["nb:4"]
    assert landing.series_cards(spark, f"{tmp_path}/site", "none").collect() == []


def test_pages_sort_by_number(spark):
    df = spark.createDataFrame([("/r/uk_p10.html/part-0",), ("/r/uk_p2.html",), ("/r/x.html",)], "path string")
    locale, number = landing.page_of(F.col("path"))
    assert [tuple(r) for r in df.select(locale, number.cast("int").alias("n")).orderBy(F.col("n").asc_nulls_last()).collect()] == [("uk", 2), ("uk", 10), (None, None)]


def test_snapshots_and_side_outputs(spark, tmp_path):
    for number in (1, 2, 10):
        landing.write_snapshot(spark.range(number), str(tmp_path), "t", number)
    (tmp_path / "tables/t/snapshot=11").mkdir()  # cut off
    assert landing.read_snapshot(spark, str(tmp_path), "t").count() == 10
    for run in ("a", "b"):
        landing.write_side(spark.range(2), str(tmp_path), "anomalies", run)
    assert sorted(r.run for r in landing.read_side(spark, str(tmp_path), "anomalies", "id long").collect()) == ["a", "a", "b", "b"]


def test_uploads_copy_what_has_a_content_type(spark, tmp_path):
    (tmp_path / "a.png").write_bytes(png(2, 2))
    (tmp_path / "b.txt").write_bytes(b"x")
    files = spark.createDataFrame([(f"file://{tmp_path}/{n}", f"k/{n}") for n in ("a.png", "b.txt")], "path string, key string")
    for _ in range(2):
        assert [tuple(r) for r in landing.upload(files, f"file://{tmp_path}/store").collect()] == [("k/a.png", "image/png", len(png(2, 2)))]
    assert (tmp_path / "store/k/a.png").read_bytes() == png(2, 2)


def test_runs_are_reported_and_never_changed(spark, tmp_path):
    with report.JobRun(spark, str(tmp_path), "load", "1") as run:
        run.note(n=3)
    with pytest.raises(KeyError), report.JobRun(spark, str(tmp_path), "load", "2"):
        raise KeyError("x")
    report.JobRun(spark, str(tmp_path), "load", "3").__enter__()
    found = {r.run: (r.state, r.error, r.notes) for r in report.job_runs(spark, str(tmp_path)).collect()}
    assert found == {"1": ("finished", None, {"n": 3}), "2": ("crashed", "KeyError", {}), "3": ("running", None, {})}
    with pytest.warns(UserWarning, match="isn't reported"), report.JobRun(spark, "nowhere://x", "load", "4"):
        pass


def test_addresses_are_absolute(spark):
    given = ["/a.jpg", "b.jpg", "//h/c.jpg", "https://x.y/z", "", None]
    df = spark.createDataFrame([(i, u) for i, u in enumerate(given)], "i int, u string")
    found = [r.x for r in df.select("i", cards.absolute(F.col("u"), "https://site.example/list/p").alias("x")).orderBy("i").collect()]
    assert found == ["https://site.example/a.jpg", "https://site.example/list/b.jpg", "https://h/c.jpg", "https://x.y/z", "https://site.example/list/p", None]


def test_twins_take_the_batch_s_id_first(spark):
    plans = spark.createDataFrame([(1, 2), (3, 4), (5, 6), (7, 8), (9, None)], "k int, twin int")
    batch, current = spark.createDataFrame([(2, 20)], "k int, id int"), spark.createDataFrame([(2, 99, None), (4, 40, None), (1, 10, 99), (3, 30, 40)], "k int, id int, held int")
    changes, warnings = match.twin_links(plans, batch, current, "k", "twin", "id", "held")
    assert [tuple(r) for r in changes.collect()] == [(1, 99, 20)] and {tuple(r) for r in warnings.collect()} == {(5, 6), (7, 8)}


def test_entries_by_the_dictionary_s_rules(spark):
    schema = "slug string, is_official boolean, name string, membership struct<title_prefix:string,card_ids:array<string>>"
    cases = [("a", True, "n", None, []), ("a", True, "n", ("x", None), ["official with membership"]), ("a", False, "n", None, ["curated without membership"]), ("a", False, "n", (None, None), ["membership without prefix or ids"]), ("a", False, "n", (None, ["1"]), []), (None, None, "", None, ["neither official nor curated", "no name", "no slug"])]
    df = spark.createDataFrame([c[:4] for c in cases], schema).coalesce(1)
    assert [r.e for r in df.select(validate.dictionary_errors(*(F.col(c) for c in ("slug", "is_official", "name", "membership"))).alias("e")).collect()] == [c[4] for c in cases]


def test_a_load_reports_each_card_and_repeats_as_nothing(spark, tmp_path):
    refs = spark.createDataFrame([(i, f"nb:{i}", f"/c/{i}") for i in range(1, 7)] + [(6, "nb:7", "/c/7"), (8, "nb:8", "/c/8"), (8, "nb:9", "/c/9")], "id int, card string, url string")
    point = lambda d, p: {"date": f"2024-01-{d:02}", "price": p}
    given = {1: [point(1, 5), point(20, 6)], 2: [point(1, 5), point(1, 6)], 3: [], 4: [point(2, 1)], 6: [point(3, 2)], 8: [point(4, 9)], 9: [point(4, 9)]}
    bodies = spark.createDataFrame([(f"nb:{k}", json.dumps(v)) for k, v in given.items()], "card string, body string")
    meta = spark.createDataFrame([(f"nb:{k}", json.dumps({"issue_price": {"price": "7.5", "date": "2020-02-03", "text": "t"}})) for k in (1, 3)], "card string, body string")
    catalogue = spark.createDataFrame([(f"nb:{k}", k * 10) for k in (1, 2, 3, 8, 9)], "source_key string, item_id int")
    schema = cards.snapshot_rows(spark.createDataFrame([], "i int, p decimal(10,2), d date, u string"), "i", "p", "d", "u", "", "").schema
    table = tables.KeyedTable(spark, f"{tmp_path}/t", schema, loading.KEYS, "price", "observed_at", ["price", "raw"], today=date(2024, 1, 21))
    for run in (0, 1, 1):
        found = loading.load_histories(refs, spark.createDataFrame([(8,)], "id int"), bodies, meta, catalogue, table, run, "list", "issue", "UAH").collect()
        told = {r.card: (r.status, r.points, r.inserted, r.repeated, r.note) for r in found}
        new = lambda n: (n, 0) if run == 0 else (0, n)  # noqa: B023, E731
        assert told == {
            "nb:1": ("loaded", 2, *new(2), None), "nb:2": ("anomaly", 0, 0, 0, "order 1"), "nb:3": ("loaded", 1, *new(1), "issue price"), "nb:4": ("skipped:not_in_db", 1, 0, 0, None),
            "nb:5": ("skipped:no_prices_file", 0, 0, 0, None), "nb:8": ("loaded", 1, *new(1), None), "nb:9": ("loaded", 1, *new(1), None),
        }
    assert {(r.item_id, r.source) for r in table.read().collect()} == {(10, "list"), (30, "issue"), (80, "list"), (90, "list")}


def test_one_partition_is_dealt_before_parsing(spark):
    """A small file is one partition; its pages, bodies and cards are still worked on by all cores."""
    least = 4 * spark.sparkContext.defaultParallelism
    one = spark.range(0, 64, 1, 1)
    pages = markup.extracted(one.select("id", F.lit("<a data-fancybox='coin-media' href='/x'>").alias("html")), "id", "html", markup.gallery, markup.GALLERY_SCHEMA)
    points, _ = landing.histories(one.select("id", F.lit('[{"date":"2024-01-01","price":1}]').alias("body")), "id")
    empty = F.create_map().cast("map<string,string>")
    texts = F.array().cast("array<string>")
    raw = one.select(F.col("id").cast("string").alias("card_id"), *(F.lit("t").alias(f"{x}_title") for x in ("uk", "en")), *(empty.alias(f"{x}_marks") for x in ("uk", "en")), *(texts.alias(c) for c in ("uk_texts", "en_texts", "images", "big_images")))
    for df in (pages, points, cards.canonical(raw, "nb")):
        assert df.rdd.getNumPartitions() >= least and df.count() == 64


def test_many_pages_are_files_that_tasks_write(spark, tmp_path):
    names = [f"{x}_p{i}.html" for x in ("en", "none") for i in range(1, 101)]
    df = spark.createDataFrame([(n, f"<p>{n}</p>") for n in names] + [("a/b/n.txt", None)], "name string, body string")
    for root in (str(tmp_path), f"file://{tmp_path}"):
        assert {(r.name, r.bytes) for r in landing.write_files(df, "name", "body", root).collect()} == {(n, len(n) + 7) for n in names} | {("a/b/n.txt", 0)}
    assert (tmp_path / "en_p7.html").read_text() == "<p>en_p7.html</p>" and (tmp_path / "a/b/n.txt").read_text() == ""
    found = landing.pages(spark, str(tmp_path), "*_p*.html")
    assert {(r.path.rsplit("/", 1)[1], r.html) for r in found.collect()} == {(n, f"<p>{n}</p>") for n in names}
    # The folder is listed, not each page.
    assert len(list(found._jdf.queryExecution().analyzed().collectLeaves().head().relation().location().rootPaths().mkString("\n").split("\n"))) == 1


def test_a_listing_reads_pages_that_tasks_wrote(tmp_path):
    (tmp_path / "locale=en").mkdir()
    (tmp_path / "locale=en" / "page=2.html").write_text("<article>п")
    site = streams.LandedListing({"root": str(tmp_path), "named": "x"})
    assert [(r.status, r.body) for r in (site.page("en", "x", n) for n in (2, 3))] == [(200, "<article>п"), (404, "")]
