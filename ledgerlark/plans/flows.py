"""Queries of pages, loads, matches and runs: their inputs are spelt out from whole tables, and the SQL gives the same rows from those tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerlark.functions import text
from ledgerlark.operators import cards as card_rows
from ledgerlark.operators import images, match, pick, report, upsert, validate
from ledgerlark.plans.catalogue import read, registered
from ledgerlark.plans.shared import shared_folder
from ledgerlark.sources import landing, markup
from ledgerlark.streaming import microbatch


def cat(*pieces: Column | str) -> Column:
    return F.concat(*(F.lit(p) if isinstance(p, str) else p.cast("string") for p in pieces))


def thousands(c: Column) -> Column:
    """1 234.50, as pages print amounts."""
    return F.replace(F.format_number(c, 2), F.lit(","), F.lit(" "))


# ---- pages --------------------------------------------------------------------------------------------


@registered(
    "year_table",
    """SELECT p_partkey AS row_id, '/list/' || p_partkey || '-x' AS url, p_name AS title, CAST(p_size AS DOUBLE) AS value,
         round(p_retailprice, 2) AS price, DATE '2026-09-08' AS as_of, CAST(NULL AS VARCHAR) AS anomaly FROM part WHERE p_partkey // 10 % 4 <> 0
       UNION ALL SELECT DISTINCT NULL, NULL, NULL, NULL, NULL, NULL, 'no day in the price column' FROM part WHERE p_partkey // 10 % 4 = 0""",
)
def year_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Year tables of ten parts each; every fourth has no day in its header, which rejects it (PJ6, PJ7, SC3)."""
    row = cat('<tr><td data-title="Назва"><a href="/list/', F.col("p_partkey"), '-x/" title="', F.col("p_name"), '">x</a></td><td data-title="Номінал">', F.col("p_size"), ' (грн)</td><td class="ua-table-price-cell">', thousands(F.col("p_retailprice")), " ↑</td></tr><tr><td>-</td></tr>")
    part = read(spark, sf_dir, "part").select((F.col("p_partkey") / 10).cast("long").alias("page"), "p_partkey", row.alias("tr"))
    tables = part.groupBy("page").agg(F.array_join(F.array_sort(F.collect_list("tr")), "").alias("trs"))
    day = F.when(F.col("page") % 4 == 0, "скоро").otherwise("08.09.2026")
    html = tables.select("page", cat('<table class="coin-list"><thead><tr><th>Вартість ', day, "</th></tr></thead>", F.col("trs"), "</table>").alias("html"))
    found = markup.extracted(html, "page", "html", markup.year_rows, markup.YEAR_SCHEMA)
    rows = found.select("row_id", F.regexp_replace("url", "/$", "").alias("url"), "title", "value", F.col("price").cast("double").alias("price"), "as_of", "anomaly")
    good, bad = rows.filter("anomaly is null"), rows.filter("anomaly is not null").distinct()
    return good.unionByName(bad)


@registered(
    "result_cards",
    """SELECT CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE CAST(p_partkey AS VARCHAR) END AS card_id, p_name AS title, CAST(p_size AS VARCHAR) AS size_mark, 'a|' || p_brand || '|' AS descriptions,
         CASE WHEN p_partkey % 5 = 0 THEN NULL WHEN p_partkey % 2 = 0 THEN '/big/' || p_partkey || '.jpg' END AS big FROM part""",
)
def result_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Result blocks as raw cards: id, title, labels, three descriptions and the lightbox link (PJ1, PJ3, PJ12)."""
    key = F.col("p_partkey")
    img = cat('<img src="/i/', key, '_o.jpg">')
    linked = F.when(key % 2 == 0, cat('<a class="big-image" href="/big/', key, '.jpg">', img, "</a>")).otherwise(img)
    box = F.when(key % 5 == 0, "").otherwise(cat('<div class="img-container">', linked, "</div>"))
    html = cat('<div class="search-result">', box, '<div class="title"> ', F.col("p_name"), ' </div><p><span class="mark">Розмір</span><span class="mark-text">', F.col("p_size"), '</span></p><div class="description__text">a</div><div class="description__text">', F.col("p_brand"), '</div><div class="description__text"> </div></div>')
    found = markup.extracted(read(spark, sf_dir, "part").select("p_partkey", html.alias("html")), "p_partkey", "html", markup.cards, markup.CARD_SCHEMA)
    return found.select("card_id", "title", F.col("marks")["Розмір"].alias("size_mark"), F.array_join("descriptions", "|").alias("descriptions"), F.get("big_images", F.lit(0)).alias("big"))


@registered(
    "chart_endpoint",
    """SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN '/coin/prices/' || p_partkey || '?_h=1&e=2' WHEN 1 THEN '/coin/prices/' || p_partkey ELSE '/coin/prices/7?s=' || p_size END AS path,
         p_partkey % 3 <> 1 AS signed FROM part""",
)
def chart_endpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page's chart address in any escaping: its own id first, signed before unsigned (PJ8)."""
    key = F.col("p_partkey")
    own = cat('<a href="/coin/prices/', key, '">x</a>')
    escaped = cat('<div data-x="{&quot;u&quot;:&quot;\\/coin\\/prices\\/', key, '?_h=1&amp;e=2&quot;}">')
    other = cat('<script>"/coin/prices/7?s=', F.col("p_size"), '"</script>')
    html = cat(other, F.when(key % 3 == 0, cat(own, escaped)).when(key % 3 == 1, own).otherwise(""))
    part = read(spark, sf_dir, "part").select("p_partkey", F.when(key == 7, own).otherwise(html).alias("html"))
    found = markup.extracted(part, "p_partkey", "html", markup.endpoints, markup.ENDPOINT_SCHEMA)
    return markup.chosen_endpoint(found, "p_partkey", key).select("p_partkey", "path", "signed")


@registered(
    "stated_price",
    """SELECT p_partkey, CAST(CASE p_partkey % 4 WHEN 3 THEN NULL ELSE round(p_retailprice, 2) END AS DOUBLE) AS price,
         CASE p_partkey % 4 WHEN 2 THEN DATE '2020-02-01' WHEN 3 THEN NULL ELSE DATE '2026-09-08' END AS day, CASE p_partkey % 4 WHEN 0 THEN 'note' WHEN 1 THEN 'sentence' WHEN 2 THEN 'scan' END AS found_by FROM part""",
)
def stated_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The price that a landed page states: note, sentence, dated amount, or none (PJ9, SC5, SC6)."""
    key, amount = F.col("p_partkey"), thousands(F.col("p_retailprice"))
    note = cat('<body><h1>5 грн., 1999</h1><p class="coin-price-note__text">Станом на 08.09.2026 — ', amount, " грн</p></body>")
    sentence = cat("<body><h1>5 ₴</h1><div>станом  на 08.09.2026: ", amount, " UAH</div></body>")
    scan = cat("<body><div><h1>5 грн</h1></div><p>на 01.02.2020: ", amount, " грн</p></body>")
    html = F.when(key % 4 == 0, note).when(key % 4 == 1, sentence).when(key % 4 == 2, scan).otherwise("<body>немає даних 2020</body>")
    landed = read(spark, sf_dir, "part").select("p_partkey", html.alias("html"), key.alias("own"))
    return landing.recheck(landed, "p_partkey", "html", "own").select("p_partkey", F.col("price").cast("double").alias("price"), "day", "found_by")


@registered(
    "issue_price",
    "SELECT p_partkey, CAST(round(p_retailprice, 2) AS DOUBLE) AS price, DATE '2024-04-03' AS day FROM part WHERE p_partkey % 3 <> 0",
)
def issue_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The issue price from its widget alone, never from the rest of the page (PJ10)."""
    amount = F.replace(thousands(F.col("p_retailprice")), F.lit(" "), F.lit(" "))
    widget = cat('<div class="market-pending"><b class="market-pending__price">', amount, ' грн</b><i class="market-pending__price-label">від 03.04.2024</i></div>')
    html = F.when(F.col("p_partkey") % 3 == 0, "<h1>5 грн</h1>").otherwise(widget)
    found = markup.extracted(read(spark, sf_dir, "part").select("p_partkey", html.alias("html")), "p_partkey", "html", markup.issue_prices, markup.PRICE_SCHEMA)
    return found.select("p_partkey", F.col("price").cast("double").alias("price"), "day")


@registered("landed_pages", "SELECT page_id, md5(html) AS digest, length(html) AS n FROM pages WHERE html IS NOT NULL")
def landed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written as they came and read back by run (SK12, SC8, SC9)."""
    root = shared_folder(spark, "landed")
    pages = read(spark, sf_dir, "pages").filter("html is not null")
    landing.write_pages(pages.select(F.col("page_id").cast("string").alias("name"), F.col("html").alias("body")), root, "pages", "1")
    return landing.read_pages(spark, root, "pages").select(F.col("name").cast("long").alias("page_id"), F.md5("body").alias("digest"), F.length("body").cast("long").alias("n"))


@registered(
    "point_histories",
    """SELECT event_id, CAST(ts AS DATE) AS day, CASE WHEN event_id % 3 = 0 THEN NULL ELSE round(value, 2) END AS price, TRUE AS is_list FROM events WHERE event_id % 10 <> 0
       UNION ALL SELECT event_id, NULL, NULL, FALSE FROM events WHERE event_id % 10 = 0""",
)
def point_histories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points of landed histories: typed, a boolean price refused, a body that is no list told (SC11, FN18)."""
    price = F.when(F.col("event_id") % 3 == 0, "true").when(F.col("event_id") % 3 == 1, F.round("value", 2).cast("string")).otherwise(cat('"', F.round("value", 2).cast("string"), '"'))
    body = F.when(F.col("event_id") % 10 == 0, "{}").otherwise(cat('[{"date":"', F.date_format("ts", "yyyy-MM-dd"), '","price":', price, "}]"))
    found = landing.points(read(spark, sf_dir, "events").select("event_id", body.alias("body")), "event_id")
    return found.select("event_id", "day", F.col("price").cast("double").alias("price"), "is_list")


@registered(
    "archive_rates",
    "SELECT 'USD' AS currency, CAST(ts AS DATE) AS day, CAST(CAST(round(abs(value), 4) AS DECIMAL(14,6)) AS DOUBLE) AS rate FROM events",
)
def archive_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rates of archive bodies; rows of another currency are dropped (SC7, FL5)."""
    def one(code: str, rate: Column) -> Column:
        return cat('{"exchangedate":"', F.date_format("ts", "dd.MM.yyyy"), f'","cc":"{code}","rate_per_unit":', rate, "}")

    rate = F.round(F.abs("value"), 4).cast("decimal(14,6)").cast("string")
    bodies = read(spark, sf_dir, "events").select(cat("[", one("USD", rate), ",", one("EUR", F.lit("1.5")), "]").alias("body"))
    return landing.rates(bodies, "USD").select("currency", "day", F.col("rate").cast("double").alias("rate"))


@registered("metadata_prices", "SELECT o_orderkey, CAST(round(o_totalprice, 2) AS DOUBLE) AS price, CAST(o_orderdate AS DATE) AS day FROM orders WHERE o_orderkey % 4 = 0")
def metadata_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Issue prices of landed metadata; any malformed field gives no row (SC12)."""
    kind = F.col("o_orderkey") % 4
    price = F.when(kind == 1, "null").when(kind == 2, '"x"').otherwise(cat('"', F.round("o_totalprice", 2).cast("decimal(14,2)").cast("string"), '"'))
    day = F.when(kind == 3, "soon").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    bodies = read(spark, sf_dir, "orders").select("o_orderkey", cat('{"issue_price":{"price":', price, ',"date":"', day, '","text":"t"}}').alias("body"))
    return landing.issue_prices(bodies, "o_orderkey").select("o_orderkey", F.col("price").cast("double").alias("price"), "day")


@registered(
    "stale_histories",
    """WITH m AS (SELECT o_custkey, max(o_orderkey) AS id FROM orders WHERE o_orderstatus <> 'O' GROUP BY 1), n AS (SELECT o_custkey, max(o_orderkey) AS id FROM orders GROUP BY 1)
       SELECT c_custkey FROM customer LEFT JOIN n ON n.o_custkey = c_custkey LEFT JOIN m ON m.o_custkey = c_custkey WHERE n.id IS DISTINCT FROM m.id""",
)
def stale_histories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers whose closed orders end with another order than all do (SC6)."""
    orders = read(spark, sf_dir, "orders")
    meta = orders.filter("o_orderstatus <> 'O'").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max("o_orderkey").alias("meta_id"))
    newest = orders.groupBy(F.col("o_custkey").alias("k")).agg(F.max("o_orderkey").alias("match_id"))
    customers = read(spark, sf_dir, "customer").select("c_custkey").join(newest, F.col("c_custkey") == F.col("k"), "left")
    return landing.stale(meta, customers, "c_custkey", "meta_id", "match_id")


# ---- writes -------------------------------------------------------------------------------------------


@registered(
    "stamped_links",
    """SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate AS DATE) ELSE DATE '2030-01-01' END AS matched_at FROM orders""",
)
def stamped_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of equal values keep their time stamp, others get a new one (SK8)."""
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", F.to_date("o_orderdate").alias("matched_at"))
    current = orders.select("o_orderkey", F.when(F.col("o_orderstatus") == "F", F.col("o_custkey")).otherwise(-1).alias("o_custkey"), "matched_at")
    return upsert.upsert_links(current, orders.select("o_orderkey", "o_custkey"), ["o_orderkey"], ["o_custkey"], "matched_at", F.lit("2030-01-01").cast("date"))


@registered(
    "dictionary_ids",
    """WITH old AS (SELECT p_brand, dense_rank() OVER (ORDER BY p_brand) AS id FROM (SELECT DISTINCT p_brand FROM part WHERE p_size <= 10)),
       new AS (SELECT DISTINCT p_brand FROM part WHERE p_brand NOT IN (SELECT p_brand FROM old))
       SELECT p_brand, id FROM old UNION ALL SELECT p_brand, (SELECT coalesce(max(id), 0) FROM old) + row_number() OVER (ORDER BY p_brand) FROM new""",
)
def dictionary_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New names of a dictionary get the next ids, in order (SK10)."""
    part = read(spark, sf_dir, "part")
    old = upsert.get_or_create(spark.createDataFrame([], "p_brand string, id long"), part.filter("p_size <= 10").select("p_brand"), ["p_brand"], "id")
    return upsert.get_or_create(old, part.select("p_brand"), ["p_brand"], "id")


@registered(
    "snapshot_rows",
    """SELECT o_custkey AS item_id, 'list' AS source, CAST(NULL AS VARCHAR) AS grade, CAST(CAST(o_totalprice AS DECIMAL(14,2)) AS DOUBLE) AS price, 'UAH' AS currency, CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS observed_at,
         '/o/' || o_orderkey AS source_url, '{"date":"' || strftime(o_orderdate, '%Y-%m-%d') || '","price":"' || CAST(CAST(o_totalprice AS DECIMAL(14,2)) AS VARCHAR) || '"}' AS raw FROM orders WHERE o_totalprice > 0""",
)
def snapshot_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quotes as typed snapshot rows (PJ16, SK1, FN19)."""
    quotes = read(spark, sf_dir, "orders").select("o_custkey", "o_totalprice", F.to_date("o_orderdate").alias("day"), cat("/o/", F.col("o_orderkey")).alias("url"))
    return card_rows.snapshot_rows(quotes, "o_custkey", "o_totalprice", "day", "url", "list", "UAH").withColumn("price", F.col("price").cast("double"))


RAW_SQL = """r AS (SELECT p_partkey, p_partkey % 6 AS k, p_name, p_size, p_retailprice, p_brand FROM part)"""


def raw_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw cards of two languages spelt out from parts; one in six lacks the second language, one has an unlisted material, one no date."""
    k = F.col("p_partkey") % 6
    uk = F.create_map(
        F.lit("Номінал"), cat(F.col("p_size"), " грн"),
        F.lit("Дата введення в обіг"), F.when(k == 5, "").otherwise("08.09.2020"),
        F.lit("Матеріал"), F.when(k == 1, "невідомий").when(k == 2, "").otherwise("Срібло"),
        F.lit("Тираж"), cat("до ", F.col("p_size"), " 000/0"),
        F.lit("Вага у чистоті"), F.lit("15,55"),
        F.lit("Художник"), F.lit("А, Б"),
    )
    en = F.when(k != 0, F.create_map(F.lit("Material"), F.lit("золото"), F.lit("Designer"), F.lit("A")))
    texts = F.array(F.lit("g"), F.col("p_brand"), F.lit(""))
    return read(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("card_id"),
        cat("«", F.col("p_name"), "» (с)").alias("uk_title"),
        F.when(k != 0, F.col("p_name")).alias("en_title"),
        uk.alias("uk_marks"),
        en.alias("en_marks"),
        texts.alias("uk_texts"),
        F.when(k != 0, texts).alias("en_texts"),
        F.array(cat("/i/", F.col("p_partkey"), ".jpg")).alias("images"),
        F.array().cast("array<string>").alias("big_images"),
    )


@registered(
    "canonical_cards",
    f"""WITH {RAW_SQL} SELECT 'nb:' || p_partkey AS source_id, p_name AS title_uk, CASE WHEN k <> 0 THEN p_name END AS title_en, 'с' AS metal_suffix, CAST(p_size AS DOUBLE) AS value, 'hryvnia' AS unit,
         CASE WHEN k <> 5 THEN 2020 END AS year, CASE WHEN k = 1 THEN NULL WHEN k = 2 THEN 'gold' ELSE 'silver' END AS material, CAST(p_size AS BIGINT) * 1000 AS announced, CAST(0 AS BIGINT) AS actual, CAST(15.55 AS DOUBLE) AS fine_weight,
         p_brand AS obverse, CASE WHEN k <> 0 THEN 'А/A,Б/-' ELSE 'А/-,Б/-' END AS designers, '/i/' || p_partkey || '.jpg' AS picture, CASE WHEN k = 1 THEN 'material' ELSE '' END AS unknown FROM r""",
)
def canonical_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested cards of raw pairs (PJ5, PJ2, PJ4, FL7, FN13, FN15)."""
    c = card_rows.canonical(raw_cards(spark, sf_dir), "nb")
    people = F.array_join(F.transform("artists.designers", lambda d: F.concat_ws("/", d["uk"], F.coalesce(d["en"], F.lit("-")))), ",")
    return c.select("source_id", F.col("titles.uk").alias("title_uk"), F.col("titles.en").alias("title_en"), "metal_suffix", "denomination.value", "denomination.unit", "year", "material", "mintage.announced", "mintage.actual", F.col("fine_weight_grams").alias("fine_weight"), F.col("description.uk.obverse").alias("obverse"), people.alias("designers"), F.col("images.obverse_url").alias("picture"), F.array_join("unknown", ",").alias("unknown"))


@registered(
    "catalogue_values",
    f"""WITH {RAW_SQL} SELECT 'nb:' || p_partkey AS source_key, CASE WHEN k = 1 THEN 'unknown' ELSE 'precious' END AS metal_kind, CAST(15.55 AS DOUBLE) AS weight, CASE WHEN k = 5 THEN 'no year' END AS reason,
         CASE WHEN k = 5 THEN NULL ELSE list_contains(['x'], 'y') END AS has_diameter, CASE WHEN k = 5 THEN NULL ELSE k <> 0 END AS has_title_en, CASE WHEN k = 5 THEN NULL ELSE true END AS has_mintage_actual FROM r""",
)
def catalogue_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalogue columns of cards, absent ones told, cards without a year rejected (PJ13)."""
    path = f"{shared_folder(spark, 'cards')}/canonical"
    card_rows.canonical(raw_cards(spark, sf_dir), "nb").withColumns({"series": F.lit(1), "denom": F.lit(2)}).write.parquet(path)
    cards = spark.read.parquet(path)  # both outputs come from the written cards
    rows, rejected = card_rows.item_values(cards, "series", "denom")
    told = rows.select("source_key", "metal_kind", F.col("weight_grams").cast("double").alias("weight"), F.lit(None).cast("string").alias("reason"), *(F.array_contains("present", c).alias(f"has_{n}") for n, c in (("diameter", "diameter_mm"), ("title_en", "title_en"), ("mintage_actual", "mintage_actual"))))
    bad = rejected.join(cards, "source_id").select(F.col("source_id").alias("source_key"), F.when(F.col("material").isNull(), "unknown").otherwise("precious").alias("metal_kind"), F.col("fine_weight_grams").alias("weight"), "reason", *(F.lit(None).cast("boolean").alias(f"has_{n}") for n in ("diameter", "title_en", "mintage_actual")))
    return told.unionByName(bad)


@registered(
    "series_columns",
    """SELECT n_nationkey AS slug, n_name AS name_uk, CASE WHEN n_regionkey = 0 THEN 'manual' ELSE 'official' END AS name_uk_source, CASE WHEN n_regionkey <> 1 THEN n_name END AS name_en, n_regionkey <> 1 AS has_en, n_regionkey = 2 AS has_years FROM nation""",
)
def series_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dictionary entries as series columns, absent ones told (PJ14)."""
    region = F.col("n_regionkey")
    years = F.when(region == 2, 1999)
    entries = read(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("slug"), cat(" ", F.col("n_name")).alias("uk"), F.when(region != 1, cat(F.col("n_name"), " ")).alias("en"), F.when(region == 0, False).alias("is_official"), years.alias("first_year"), years.alias("last_year"))
    out = card_rows.series_values(entries)
    return out.select("slug", "name_uk", "name_uk_source", "name_en", F.array_contains("present", "name_en").alias("has_en"), F.array_contains("present", "start_year").alias("has_years"))


@registered(
    "media_uploads",
    """SELECT l_orderkey, 'r' || l_linenumber AS role, count(*) FILTER (WHERE l_returnflag <> 'R') AS n_files, sum(CASE WHEN l_returnflag <> 'R' THEN CAST(l_quantity AS BIGINT) END) AS total_bytes,
         max(CASE WHEN l_returnflag <> 'R' THEN s END) AS largest, count(*) FILTER (WHERE l_returnflag = 'R') AS n_lost
       FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice) AS s FROM lineitem) GROUP BY 1, 2""",
)
def media_uploads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One media row for each card and role, notes on what is lacking (PJ15)."""
    n = F.row_number().over(Window.partitionBy("l_orderkey", "l_linenumber").orderBy("l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"))
    lines = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag", n.alias("size"))
    lines = lines.withColumn("file", F.concat_ws("-", "l_orderkey", "l_linenumber", "size"))
    photos = lines.groupBy("l_orderkey", cat("r", F.col("l_linenumber")).alias("role")).agg(F.array_sort(F.collect_list(F.struct("size", "file"))).alias("sizes"))
    files = lines.filter("l_returnflag <> 'R'").select("file", F.col("l_quantity").cast("long").alias("bytes"), F.md5("file").alias("sha256"), F.col("size").alias("width"), F.col("size").alias("height"))
    media, notes = card_rows.media_rows(photos, files, "l_orderkey")
    both = media.join(notes, ["l_orderkey", "role"], "full")
    return both.select("l_orderkey", "role", F.coalesce(F.cardinality("keys"), F.lit(0)).cast("long").alias("n_files"), "total_bytes", F.col("width").alias("largest"), F.coalesce(F.cardinality("lost"), F.lit(0)).cast("long").alias("n_lost"))


# ---- matches ------------------------------------------------------------------------------------------


@registered(
    "required_references",
    """SELECT o_orderkey, c_name, c_custkey IS NULL AS missing FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) ON o_custkey = c_custkey""",
)
def required_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders whose customer isn't in good standing are rejected with their own columns (JN11, JN17)."""
    orders, good = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), read(spark, sf_dir, "customer").filter("c_acctbal > 0")
    found, lost = match.resolve(orders, good.select("c_custkey", "c_name"), "o_custkey", "c_custkey", ["c_name"], required=True)
    return found.select("o_orderkey", "c_name", F.lit(False).alias("missing")).unionByName(lost.select("o_orderkey", F.lit(None).cast("string").alias("c_name"), F.lit(True).alias("missing")))


@registered(
    "adopted_links",
    "SELECT o_custkey, o_orderkey, count(*) OVER (PARTITION BY o_custkey) = 1 AS adopted FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus = 'P'",
)
def adopted_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys with exactly one hit are adopted, others are told (JN12)."""
    links = read(spark, sf_dir, "orders").filter("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey")
    one, many = match.unique_inner(read(spark, sf_dir, "customer").select("c_custkey"), links, "c_custkey")
    return one.withColumn("adopted", F.lit(True)).unionByName(many.withColumn("adopted", F.lit(False))).withColumnRenamed("c_custkey", "o_custkey")


@registered(
    "first_known_price",
    """WITH b AS (SELECT o_custkey, max(o_totalprice) AS v FROM orders WHERE o_orderstatus = 'P' GROUP BY 1), c AS (SELECT o_custkey, max(o_totalprice) AS v FROM orders GROUP BY 1)
       SELECT c_custkey, coalesce(b.v, c.v) AS v FROM customer LEFT JOIN b ON b.o_custkey = c_custkey LEFT JOIN c ON c.o_custkey = c_custkey""",
)
def first_known_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A value from the batch, else from what there was (JN14)."""
    orders = read(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "c_custkey")
    batch, current = (rows.groupBy("c_custkey").agg(F.max("o_totalprice").alias("v")) for rows in (orders.filter("o_orderstatus = 'P'"), orders))
    return match.first_known(read(spark, sf_dir, "customer").select("c_custkey"), batch, current, "c_custkey", "v")


@registered(
    "linked_scope",
    """SELECT c_custkey, id AS link_id FROM customer LEFT JOIN (SELECT o_custkey, max(CASE WHEN o_orderstatus = 'P' THEN o_orderkey END) AS id FROM orders GROUP BY 1) ON o_custkey = c_custkey""",
)
def linked_scope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A scope's links, and members without one or without an id in it (JN8, FL1)."""
    links = read(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max(F.when(F.col("o_orderstatus") == "P", F.col("o_orderkey"))).alias("link_id"))
    linked, without = match.unlinked(read(spark, sf_dir, "customer").select("c_custkey"), links, "c_custkey")
    return linked.unionByName(without.withColumn("link_id", F.lit(None).cast("long")))


@registered(
    "catalogue_sync",
    """WITH l AS (SELECT p_partkey, p_brand AS g FROM part WHERE p_size > 10), k AS (SELECT p_partkey, CASE WHEN p_size < 20 THEN 'old' ELSE p_brand END AS g FROM part WHERE p_size < 40)
       SELECT coalesce(l.p_partkey, k.p_partkey) AS p_partkey, CASE WHEN l.p_partkey IS NULL THEN k.g ELSE l.g END AS g,
         CASE WHEN k.p_partkey IS NULL THEN 'new' WHEN l.p_partkey IS NULL THEN 'gone' WHEN k.g <> l.g THEN 'moved' ELSE 'same' END AS state FROM l FULL JOIN k ON l.p_partkey = k.p_partkey""",
)
def catalogue_sync(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listed keys against known ones: new, moved, gone, same (JN20, PJ12)."""
    part = read(spark, sf_dir, "part")
    listed = part.filter("p_size > 10").select("p_partkey", F.col("p_brand").alias("g"))
    known = part.filter("p_size < 40").select("p_partkey", F.when(F.col("p_size") < 20, "old").otherwise(F.col("p_brand")).alias("g"))
    return match.sync(listed, known, "p_partkey", "g")


@registered(
    "noted_carry_forward",
    "SELECT p_partkey, CASE WHEN p_size < 25 THEN p_brand END AS p_brand, CASE WHEN p_size >= 25 THEN 'no earlier card' END AS note FROM part",
)
def noted_carry_forward(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Earlier values by key, with a note where there were none (JN21, JN2)."""
    part = read(spark, sf_dir, "part")
    return match.with_earlier_notes(part.select("p_partkey"), part.filter("p_size < 25").select("p_partkey", "p_brand"), "p_partkey", ["p_brand"])


@registered(
    "quality_match",
    """SELECT p_partkey AS card, 'matched' AS status, 'exact' AS matched_by, p_partkey * 10 + p_partkey % 2 AS row, 2000 + p_partkey % 20 AS year_used, FALSE AS shared_listing FROM part WHERE p_partkey % 4 < 2
       UNION ALL SELECT p_partkey, 'ambiguous', NULL, NULL, NULL, FALSE FROM part WHERE p_partkey % 4 = 2
       UNION ALL SELECT p_partkey, 'matched', 'year_shift', p_partkey * 10, 2001 + p_partkey % 20, FALSE FROM part WHERE p_partkey % 4 = 3""",
)
def quality_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listings that differ by the quality in brackets go to the card of that quality; others stay ambiguous; a year beside counts only without one of the same (JN3-JN7)."""
    key = F.col("p_partkey")
    part = read(spark, sf_dir, "part").select(key, cat("n", key).alias("title"), (2000 + key % 20).cast("int").alias("year"), F.col("p_size").alias("value"), F.lit(None).cast("string").alias("pack"))
    cards = part.select(key.alias("card"), "title", "year", "value", "pack", F.when(key % 4 == 0, "Proof").when(key % 4 == 1, "plain").alias("quality"))
    both = part.filter(key % 4 < 3).select("*", F.explode(F.array(F.struct(F.lit(0).alias("i"), F.lit("proof").alias("q")), F.struct(F.lit(1).alias("i"), F.lit("Plain").alias("q")))).alias("x"))
    rows = both.select((key * 10 + F.col("x.i")).alias("row"), cat(F.col("title"), " (", F.col("x.q"), ")").alias("title"), "year", "value", "pack")
    rows = rows.unionByName(part.filter(key % 4 == 3).select((key * 10).alias("row"), "title", (F.col("year") + 1).alias("year"), "value", "pack"))
    return match.match(cards, rows).drop("candidates")


@registered(
    "dictionary_merge",
    """WITH e AS (SELECT n_name AS name, lower(n_name) || '-old' AS slug, FALSE AS curated, n_regionkey FROM nation WHERE n_regionkey IN (1, 2) UNION ALL SELECT r_name, lower(r_name) || '-r', r_regionkey = 0, NULL FROM region),
       f AS (SELECT CASE WHEN n_nationkey < 12 THEN '«' || n_name || '»' ELSE n_name END AS name, n_name, n_regionkey, (SELECT count(*) FROM customer WHERE c_nationkey = n_nationkey) AS n FROM nation)
       SELECT name, CASE WHEN n_regionkey IN (1, 2) THEN lower(n_name) || '-old' ELSE replace(lower(n_name), '_', '-') END AS slug, FALSE AS curated, FALSE AS missing, n FROM f
       UNION ALL SELECT name, slug, curated, NOT curated, NULL FROM e WHERE n_regionkey IS NULL""",
)
def dictionary_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dictionary's next state (JN16, WN6): the nations as they are now, some in quotes, against entries of two regions' nations and of all regions.

    Names that differ in quotes alone are one; their slugs stay and their counts are new; other nations get free slugs; regions have
    vanished, but for the curated one.
    """
    nation, region = read(spark, sf_dir, "nation"), read(spark, sf_dir, "region")
    counts = read(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.count(F.lit(1)).alias("n"))
    name = F.when(F.col("n_nationkey") < 12, cat("«", F.col("n_name"), "»")).otherwise(F.col("n_name"))
    fresh = nation.join(counts, "n_nationkey", "left").select(name.alias("name"), F.coalesce("n", F.lit(0)).cast("long").alias("n"))
    old = nation.filter("n_regionkey in (1, 2)").select(F.col("n_name").alias("name"), cat(F.lower("n_name"), "-old").alias("slug"), F.lit(False).alias("curated"), F.lit(0).cast("long").alias("n"))
    regions = region.select(F.col("r_name").alias("name"), cat(F.lower("r_name"), "-r").alias("slug"), (F.col("r_regionkey") == 0).alias("curated"), F.lit(None).cast("long").alias("n"))
    return match.merged_dictionary(fresh, old.unionByName(regions), "name", text.slug(F.col("name")))[0]


@registered(
    "free_slugs",
    """WITH r AS (SELECT p_partkey, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS i, p_brand FROM part)
       SELECT p_partkey, CASE WHEN i = 1 THEN lower(p_brand) || '-x' WHEN i = 2 THEN lower(p_brand) || '-x-3' ELSE lower(p_brand) || '-x-' || CAST(i + 1 AS VARCHAR) END AS slug FROM r""",
)
def free_slugs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slugs of equal bases, where base-2 exists already (WN6)."""
    part = read(spark, sf_dir, "part").select("p_partkey", cat(F.lower("p_brand"), "-x").alias("base"))
    return match.unique_slugs(part, "base", "p_partkey", existing=part.select(cat(F.col("base"), "-2")).distinct()).select("p_partkey", "slug")


# ---- picks, runs and photos -----------------------------------------------------------------------------


@registered(
    "best_of_page",
    """WITH t AS (SELECT o_custkey, o_orderkey, o_totalprice, o_orderstatus = 'F' AS ok, max(CAST(o_orderstatus = 'F' AS INTEGER)) OVER (PARTITION BY o_custkey) AS any_ok FROM orders)
       SELECT o_custkey, o_orderkey, pick, any_ok = 0 AS fallback FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY CASE WHEN any_ok = 1 THEN CAST(NOT ok AS INTEGER) END, CASE WHEN any_ok = 1 THEN -o_totalprice END, o_orderkey) AS pick FROM t) WHERE pick <= 2""",
)
def best_of_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accepted rows by score, else the head of the page (SO3)."""
    orders = read(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderstatus", "o_totalprice")
    return pick.pick_best(orders, ["o_custkey"], F.col("o_orderstatus") == "F", F.col("o_totalprice"), F.col("o_orderkey")).select("o_custkey", "o_orderkey", "pick", "fallback")


@registered(
    "photo_roles",
    """SELECT p_partkey AS card, pos, role, how FROM part JOIN (VALUES
         (0, 1, 'obverse', 'caption'), (0, 2, 'reverse', 'caption'),
         (1, 1, 'obverse', 'caption'), (1, 2, 'reverse', 'caption'), (1, 3, 'obverse', 'shape'), (1, 4, 'reverse', 'shape'),
         (2, 2, 'obverse', 'shape'), (2, 4, 'reverse', 'shape'),
         (3, 3, 'obverse', 'score'), (3, 1, 'reverse', 'score')) v(k, pos, role, how) ON p_partkey % 4 = k""",
)
def photo_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two sides' photos: a caption whose photos all have the wrong shape yields to an unnamed photo of the right one (WN8).

    Cards of four kinds: captions backed by shape; captions of wrong shapes with good unnamed photos; no captions, two good shapes;
    no captions and no good shape.
    """
    kinds = [
        [(1, "obverse", True, 0.5), (2, "reverse", True, 0.5), (3, None, True, 0.9)],
        [(1, "obverse", False, 0.9), (2, "reverse", False, 0.9), (3, None, True, 0.1), (4, None, True, 0.2)],
        [(1, None, False, 0.9), (2, None, True, 0.1), (3, None, False, 0.8), (4, None, True, 0.7)],
        [(1, None, False, 0.5), (2, None, False, 0.1), (3, None, False, 0.6)],
    ]
    shape = "array<struct<pos:int,said:string,ok:boolean,score:double>>"
    listed = F.get(F.array(*(F.array(*(F.struct(*map(F.lit, p)) for p in kind)).cast(shape) for kind in kinds)), (F.col("p_partkey") % 4).cast("int"))
    photos = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("card"), F.inline(listed))
    return pick.roles(photos, "card", "pos", "said", F.col("ok"), F.col("score")).select("card", "pos", "role", "how")


@registered(
    "worst_photos",
    """SELECT l_orderkey, bool_and(l_returnflag = 'N') AS is_ok, sum(l_linenumber) AS shape_objects, min(l_tax) AS solidity, max(l_discount) AS shape_extent, min(l_quantity) AS aspect,
         coalesce(arg_min(CASE WHEN l_returnflag <> 'N' THEN l_returnflag END, CASE WHEN l_returnflag <> 'N' THEN (l_linenumber, l_returnflag) END), 'ok') AS reason FROM lineitem GROUP BY 1""",
)
def worst_photos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several verdicts as one: the worst of each measure, the first reason in page order (AG8)."""
    lines = read(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_linenumber").alias("pos"), F.col("l_linenumber").alias("shape_objects"), F.col("l_tax").alias("solidity"), F.col("l_discount").alias("shape_extent"), F.col("l_quantity").alias("aspect"), F.when(F.col("l_returnflag") == "N", "ok").otherwise(F.col("l_returnflag")).alias("reason"))
    return images.worst_of(lines, ["l_orderkey"])


@registered(
    "first_of_each_id",
    "SELECT o_custkey, min(o_orderkey) AS first_key, max(o_orderkey) AS last_key, count(DISTINCT o_orderpriority) AS n_kinds FROM orders GROUP BY 1",
)
def first_of_each_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first and the last row of each id in reading order, and how many kinds it has (AG15, AG4)."""
    orders = read(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderpriority")
    first, last = (landing.first_occurrences(orders, "o_custkey", "o_orderkey", last=x).select("o_custkey", F.col("o_orderkey").alias(n)) for x, n in ((False, "first_key"), (True, "last_key")))
    kinds = orders.groupBy("o_custkey").agg(F.count_distinct("o_orderpriority").alias("n_kinds"))
    return first.join(last, "o_custkey").join(kinds, "o_custkey")


@registered(
    "until_breaker",
    """WITH m AS (SELECT o_custkey, o_orderkey, CAST(o_orderstatus = 'O' AS INTEGER) AS bad, sum(1 - CAST(o_orderstatus = 'O' AS INTEGER)) OVER (PARTITION BY o_custkey ORDER BY o_orderkey ROWS UNBOUNDED PRECEDING) AS island FROM orders),
       s AS (SELECT *, sum(bad) OVER (PARTITION BY o_custkey, island ORDER BY o_orderkey ROWS UNBOUNDED PRECEDING) AS streak FROM m),
       b AS (SELECT o_custkey, min(o_orderkey) AS stop FROM s WHERE streak >= 3 GROUP BY 1)
       SELECT s.o_custkey, s.o_orderkey FROM s LEFT JOIN b ON b.o_custkey = s.o_custkey WHERE stop IS NULL OR o_orderkey <= stop""",
)
def until_breaker(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What still runs when three failures in a row stop the rest (ST7, WN5)."""
    orders = read(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderstatus")
    return report.until_breaker(orders, ["o_custkey"], [F.col("o_orderkey")], F.col("o_orderstatus") == "O", 3).select("o_custkey", "o_orderkey")


@registered(
    "poison_rows",
    "SELECT CASE WHEN event_id % 9 = 0 THEN 'poison' ELSE 'stored' END AS side, count(*) AS n, sum(event_id) AS ids FROM events GROUP BY 1",
)
def poison_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream whose unsound rows go to a side output with their reason, batch by batch (ST6)."""
    root = shared_folder(spark, "poison")
    stream = microbatch.file_stream(spark, sf_dir, read(spark, sf_dir, "events").schema, "events.parquet").select("event_id")
    ninth = F.col("event_id") % 9 == 0
    microbatch.isolated(stream, ~ninth, F.lit("ninth"), microbatch.by_batch(f"{root}/good"), microbatch.by_batch(f"{root}/bad"), f"{root}/checkpoint").awaitTermination()
    sides = [spark.read.schema("event_id long").parquet(f"{root}/{folder}").withColumn("side", F.lit(side)) for folder, side in (("good", "stored"), ("bad", "poison"))]
    return sides[0].select("side", "event_id").unionByName(sides[1].select("side", "event_id")).groupBy("side").agg(F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("ids"))


@registered(
    "pruned_days",
    """SELECT CAST(day AS VARCHAR) AS name FROM (SELECT DISTINCT CAST(ts AS DATE) AS day FROM events) WHERE day >= (SELECT CAST(max(ts) AS DATE) - 14 FROM events)""",
)
def pruned_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily folders that are left after those older than 14 days are deleted (SK13, ST5)."""
    root = shared_folder(spark, "days")
    events = read(spark, sf_dir, "events").select("event_id", F.to_date("ts").alias("day"))
    days = [str(r["day"]) for r in events.select("day").distinct().collect()]  # a month's names
    events.groupBy("day").agg(F.count(F.lit(1)).alias("n")).write.mode("overwrite").partitionBy("day").parquet(f"{root}/by")
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root}/by")
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for d in days:  # Hive-style folders under plain day names
        files.rename(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path, f"day={d}"), spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path, d))
    gone = landing.prune(spark, f"{root}/by", max(days), 14) if days else []
    return spark.createDataFrame([(d,) for d in sorted(set(days) - set(gone))], "name string")


def drawn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A drawn photo for each nation: a disc, a bar or nothing on white, and a disc on a tint, pixel by pixel from expressions."""
    side = 96
    kind = F.col("n_nationkey") % 4
    pixel = F.sequence(F.lit(0), F.lit(side * side - 1))

    def inside(i: Column) -> Column:
        x, y = i % side - (side - 1) / 2, F.floor(i / side) - (side - 1) / 2
        return F.when((kind == 0) | (kind == 3), x * x + y * y < 900).when(kind == 1, (F.abs(x) < 40) & (F.abs(y) < 10)).otherwise(F.lit(False))

    back = F.when(kind == 3, "E1F0FF").otherwise("FFFFFF")  # blue, green, red
    data = F.unhex(F.array_join(F.transform(pixel, lambda i: F.when(inside(i), "787878").otherwise(back)), ""))
    return read(spark, sf_dir, "nation").select(F.col("n_name").alias("origin"), F.col("n_regionkey").alias("card"), F.lit(side).alias("height"), F.lit(side).alias("width"), F.lit(3).alias("nChannels"), data.alias("data"))


@registered(
    "photo_measures",
    """SELECT n_name AS origin, CASE n_nationkey % 4 WHEN 0 THEN 2 ELSE 3 END AS class, CASE n_nationkey % 4 WHEN 1 THEN 'not_round' WHEN 2 THEN 'fragments' WHEN 3 THEN 'no_uniform_background' END AS cut_verdict,
         CASE n_nationkey % 4 WHEN 1 THEN 'boxy object in frame' WHEN 2 THEN 'no object found' ELSE 'ok' END AS shape_verdict, n_nationkey % 4 IN (0, 3) AS scored FROM nation""",
)
def photo_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures, class and verdicts of drawn photos (IM1-IM7, IM9-IM13, IM15, IM16, AG12-AG14, SC15)."""
    photos, _ = images.photo_run(drawn(spark, sf_dir), "origin", "card")
    return photos.select("origin", "class", "cut_verdict", "shape_verdict", F.coalesce(F.col("score") > 0.85, F.lit(False)).alias("scored"))


@registered(
    "photo_cards",
    """WITH p AS (SELECT n_regionkey AS card, n_nationkey % 4 IN (0, 3) AS good FROM nation), c AS (SELECT card, count(*) AS n_photos, count(*) FILTER (WHERE good) AS n_good FROM p GROUP BY 1)
       SELECT card, n_photos, n_good, CASE WHEN n_good >= 2 AND n_good = n_photos THEN 'complete' WHEN n_good > 0 THEN 'partial' ELSE 'failed' END AS status FROM c""",
)
def photo_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each card's verdict in a photo run (IM16)."""
    return images.photo_run(drawn(spark, sf_dir), "origin", "card")[1]


@registered(
    "photo_sizes",
    "SELECT n_name AS origin, s AS size, s AS height, s AS width, s * s * 3 AS n FROM nation CROSS JOIN (VALUES (24), (48), (96)) v(s)",
)
def photo_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Photos in their output sizes (SK16, WN7)."""
    sizes = pick.tiers(F.col("height"), (24, 48, 200))
    return images.resampled(drawn(spark, sf_dir), "origin", sizes).select("origin", "size", "height", "width", F.octet_length("data").alias("n"))


@registered("cut_photos", "SELECT n_name AS origin, true AS trimmed FROM nation WHERE n_nationkey % 4 = 0")
def cut_photos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Photos cut out of a uniform background and trimmed (IM8)."""
    out = images.cut_out(drawn(spark, sf_dir))
    return out.select("origin", ((F.col("height") < 80) & (F.col("width") < 80) & (F.octet_length("data") == F.col("height") * F.col("width") * 4)).alias("trimmed"))


@registered("same_silhouettes", "SELECT n_name AS origin, CASE n_nationkey % 4 WHEN 0 THEN true WHEN 1 THEN false WHEN 2 THEN NULL ELSE true END AS same FROM nation")
def same_silhouettes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether each photo's outline is the first disc's (IM14)."""
    photos = drawn(spark, sf_dir)
    picture = F.struct("height", "width", "nChannels", "data")
    first = photos.join(read(spark, sf_dir, "nation").filter("n_nationkey = 0").select(F.col("n_name").alias("origin")), "origin", "left_semi").select(picture.alias("a"))
    pairs = photos.select("origin", picture.alias("b")).crossJoin(F.broadcast(first))  # one row
    return images.same_outlines(pairs, "origin").select("origin", "same")


@registered(
    "guarded_scope",
    "SELECT n_name, count(*) AS n FROM nation JOIN customer ON c_nationkey = n_nationkey WHERE n_regionkey IN (0, 1) GROUP BY 1",
)
def guarded_scope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A scan behind its guards: columns that must be there, and a scope that must not be empty (SC13, SC14, FL1, FL2)."""
    scope = validate.need_some([0, 1], "regions")
    nation = validate.need_columns(read(spark, sf_dir, "nation"), ["n_name", "n_regionkey"], "nation")
    rows = nation.filter(F.col("n_regionkey").isin(*scope)).join(read(spark, sf_dir, "customer"), F.col("c_nationkey") == F.col("n_nationkey"))
    return rows.groupBy("n_name").agg(F.count(F.lit(1)).alias("n"))
