"""Queries of streams that run night after night on what has arrived; the SQL states the tables that they leave."""

from __future__ import annotations

from pyarrow.fs import FileSystem, FileType
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerlark.operators import cards
from ledgerlark.operators.numbering import numbered, written
from ledgerlark.plans.catalogue import read, registered
from ledgerlark.plans.shared import shared_folder
from ledgerlark.sources import landing
from ledgerlark.sources.fetching import ListingSource, Response
from ledgerlark.streaming import microbatch
from ledgerlark.streaming.tables import KeyedTable, split_late, windowed_counts

#: Files of one night are one batch.
ALL_FILES = 1_000_000


def arrive(df: DataFrame, root: str, night: int) -> None:
    """A night's files in the folder that a stream watches."""
    df.write.mode("overwrite").parquet(f"{root}/in/night={night:03d}")


def arrived(spark: SparkSession, root: str, schema: StructType) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", ALL_FILES).parquet(f"{root}/in/night=*")


@registered(
    "keyed_stream",
    """WITH d AS (SELECT event_id, event_type, value, CAST(ts AS DATE) AS day, (CAST(ts AS DATE) - (SELECT min(CAST(ts AS DATE)) FROM events)) // 10 AS k FROM events),
       n AS (SELECT k, (SELECT max(day) FROM d x WHERE x.k <= y.k + 1) AS one_on, (SELECT max(day) FROM d x WHERE x.k <= y.k + 2) AS two_on FROM (SELECT DISTINCT k FROM d) y)
       SELECT event_id, day, CASE WHEN event_type = 'purchase' AND day >= one_on - 13 OR event_type = 'view' AND day >= two_on - 13 THEN value + 1 ELSE value END AS value FROM d JOIN n ON d.k = n.k""",
)
def keyed_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of ten days a night, one night's files twice; purchases come again with another value a night later, views two nights later.

    What comes again corrects rows of the last 14 days and leaves older ones as they are (ST1, ST2, ST4).
    """
    root = shared_folder(spark, "keyed")
    events = read(spark, sf_dir, "events").select("event_id", "event_type", F.to_date("ts").alias("day"), "value")
    first, last = events.agg(F.min("day"), F.max("day")).first()
    night = F.floor(F.datediff("day", F.lit(first).cast("date")) / 10).cast("int")
    table = KeyedTable(spark, f"{root}/table", events.select("event_id", "day", "value").schema, ["event_id"], "value", "day", ["value"], days=14)
    told = events.withColumn("night", night)
    later = told.filter("event_type in ('purchase', 'view')").select("event_id", "day", (F.col("value") + 1).alias("value"), (F.col("night") + F.when(F.col("event_type") == "purchase", 1).otherwise(2)).alias("night"))
    rows = told.select("event_id", "day", "value", "night").unionByName(later)
    nights = [] if first is None else [*range((last - first).days // 10 + 3)]
    for number, n in enumerate([*nights[:2], *nights[1:2], *nights[2:]]):
        arrive(rows.filter(F.col("night") == n).drop("night"), root, number)
        table.feed(arrived(spark, root, table.schema), "nightly", f"{root}/checkpoint").awaitTermination()
    return table.read()


@registered(
    "late_rows",
    """WITH d AS (SELECT event_type, ts, CAST(ts AS DATE) AS day, (CAST(ts AS DATE) - (SELECT min(CAST(ts AS DATE)) FROM events)) // 8 AS k FROM events),
       o AS (SELECT *, CASE k WHEN 1 THEN 2 WHEN 2 THEN 1 ELSE k END AS night FROM d),
       m AS (SELECT night, (SELECT max(ts) FROM o x WHERE x.night < y.night) - INTERVAL 3 DAYS AS mark FROM (SELECT DISTINCT night FROM o) y)
       SELECT day, event_type, count(*) FILTER (WHERE mark IS NULL OR day + INTERVAL 1 DAY > mark) AS n, count(*) FILTER (WHERE day + INTERVAL 1 DAY <= mark) AS n_late FROM o JOIN m ON o.night = m.night GROUP BY 1, 2""",
)
def late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight days a night, the second and the third night swapped: daily counts behind a watermark of three days, and the rows that came too late (ST3)."""
    root = shared_folder(spark, "late")
    events = read(spark, sf_dir, "events").select(F.col("ts").cast("timestamp").alias("ts"), "event_type")
    first, last = events.agg(F.min(F.to_date("ts")), F.max(F.to_date("ts"))).first()
    part = F.floor(F.datediff("ts", F.lit(first).cast("date")) / 8)
    for night in range((last - first).days // 8 + 1 if first else 0):
        arrive(events.filter(part == {1: 2, 2: 1}.get(night, night)), root, night)
        split_late(arrived(spark, root, events.schema), root, "ts", "1 day", "3 days", f"{root}/split").awaitTermination()
        ontime = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", ALL_FILES).parquet(f"{root}/ontime/batch=*")
        windowed_counts(ontime, "ts", ["event_type"], "1 day", "3 days", microbatch.by_batch(f"{root}/counts"), f"{root}/state").awaitTermination()
    if not first:
        return spark.createDataFrame([], "day date, event_type string, n long, n_late long")
    # A window is stored again by each batch that changes it; the last one holds.
    changes = spark.read.option("basePath", f"{root}/counts").parquet(f"{root}/counts").select(F.to_date("start").alias("day"), "event_type", "n", "batch")
    counts = changes.groupBy("day", "event_type").agg(F.max_by("n", "batch").alias("n"))
    late = spark.read.schema(events.schema).parquet(f"{root}/late/batch=*").groupBy(F.to_date("ts").alias("day"), "event_type").agg(F.count(F.lit(1)).alias("n_late"))
    both = counts.join(late, ["day", "event_type"], "full")
    return both.select("day", "event_type", *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n", "n_late")))


@registered(
    "two_writers",
    """WITH e AS (SELECT user_id, CAST(ts AS DATE) AS day, CAST(value AS DECIMAL(14,2)) AS price, (SELECT max(CAST(ts AS DATE)) FROM events) AS last FROM events),
       k AS (SELECT user_id, day, last FROM e WHERE price > 0 GROUP BY 1, 2, 3), x AS (SELECT DISTINCT user_id, day, last FROM e)
       SELECT 'history' AS writer, 'inserted' AS outcome, count(*) AS n FROM k WHERE day <= last - 10
       UNION ALL SELECT 'nightly', 'repeated', count(*) FROM k WHERE day BETWEEN last - 14 AND last - 10
       UNION ALL SELECT 'nightly', 'inserted', count(*) FROM k WHERE day > last - 10
       UNION ALL SELECT 'again', 'corrected', count(*) FROM k WHERE day >= last - 6
       UNION ALL SELECT 'again', 'repeated', count(*) FROM k WHERE day BETWEEN last - 20 AND last - 7
       UNION ALL SELECT 'again', 'inserted', count(*) FROM x WHERE day >= last - 20 AND NOT EXISTS (SELECT 1 FROM k WHERE k.user_id = x.user_id AND k.day = x.day) HAVING count(*) > 0""",
)
def two_writers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A history load and nightly runs write one table through one projection; where they overlap, nothing changes (ST8, PJ16).

    The history ends ten days before the last day, the nightly run begins five days earlier; then the last 21 days come once more
    with higher prices, which correct the last seven.
    """
    root = shared_folder(spark, "writers")
    events = read(spark, sf_dir, "events").select("user_id", F.to_date("ts").alias("day"), "value", F.concat(F.lit("/u/"), "user_id").alias("url"))
    last = events.agg(F.max("day")).first()[0]

    def snapshots(rows: DataFrame) -> DataFrame:
        return cards.snapshot_rows(rows, "user_id", "value", "day", "url", "list", "UAH")

    table = KeyedTable(spark, f"{root}/table", snapshots(events).schema, ["item_id", "source", "grade", "observed_at"], "price", "observed_at", ["price", "raw"], part=lambda: F.date_format("observed_at", "yyyy-MM"))
    ago = F.datediff(F.lit(last).cast("date"), "day")
    inputs = [("history", events.filter(ago >= 10)), ("nightly", events.filter(ago <= 14)), ("again", events.filter(ago <= 20).withColumn("value", F.col("value") + 1))]
    for writer, rows in inputs:
        arrive(rows, f"{root}/{writer}", 0)
        table.feed(snapshots(arrived(spark, f"{root}/{writer}", events.schema)), writer, f"{root}/{writer}/checkpoint").awaitTermination()
    return table.outcomes().select("writer", "outcome", "n")


class LandedListing(ListingSource):
    """A listing whose pages are landed as files under option root, by locale and page; a name with the right apostrophe finds them."""

    @classmethod
    def name(cls) -> str:
        return "ledgerlark_landed_listing"

    def page(self, locale: str, query: str, number: int) -> Response:
        files, path = FileSystem.from_uri(f"{self.options['root']}/locale={locale}/page={number}.html")
        if query != self.options["named"] or files.get_file_info(path).type == FileType.NotFound:
            return Response(404, "")
        with files.open_input_stream(path) as page:
            return Response(200, page.read().decode())


def listed(pages: DataFrame, per_page: int) -> DataFrame:
    """(locale, page, html): a listing's pages, each with the blocks of per_page pages of a language, in order of their ids."""
    locale = F.coalesce(F.nullif(F.regexp_extract("url", "/(en|de|fr|es)/", 1), F.lit("")), F.lit("none"))
    blocks = numbered(pages.select("page_id", locale.alias("locale")), ["locale"], ["page_id"], "place").withColumn("at", F.col("place") - 1)
    html = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "page_id"))), lambda b: F.concat(F.lit('<article data-id="'), b["page_id"].cast("string"), F.lit('">'))), "")
    return blocks.groupBy("locale", (F.floor(F.col("at") / per_page) + 1).cast("int").alias("page")).agg(html.alias("html"))


@registered(
    "paged_listing",
    """WITH p AS (SELECT page_id, coalesce(nullif(regexp_extract(url, '/(en|de|fr|es)/', 1), ''), 'none') AS locale FROM pages),
       r AS (SELECT *, row_number() OVER (PARTITION BY locale ORDER BY page_id) - 1 AS i FROM p)
       SELECT locale, 'п’ять' AS query, CAST(i // 20 + 1 AS INTEGER) AS page, CAST(i % 20 AS INTEGER) AS pos, page_id FROM r""",
)
def paged_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A listing by language read page by page, first as it was halfway, then on from there when it had grown (SC1, SC17).

    The name is asked for with another apostrophe than the site has.
    """
    root, pages = shared_folder(spark, "listing"), read(spark, sf_dir, "pages").select("page_id", "url")
    middle = pages.agg(F.percentile("page_id", F.lit(0.5))).first()[0]
    spark.dataSource.register(LandedListing)
    for upto in (pages.filter(F.col("page_id") <= middle), pages):
        name = F.concat(F.lit("locale="), "locale", F.lit("/page="), F.col("page").cast("string"), F.lit(".html"))
        written(landing.write_files(listed(upto, 20).select(name.alias("name"), "html"), "name", "html", f"{root}/site"), "names")
        source = spark.readStream.format("ledgerlark_landed_listing").options(root=f"{root}/site", locales="de,en,es,fr,none", query="п'ять", named="п’ять", per_page=20, pages_per_task=5)
        microbatch.stored(source.load(), microbatch.by_batch(f"{root}/blocks"), f"{root}/checkpoint").awaitTermination()
    blocks = spark.read.schema("locale string, query string, page int, pos int, block string").parquet(f"{root}/blocks/batch=*")
    return blocks.select("locale", "query", "page", "pos", F.regexp_extract("block", 'data-id="([0-9]+)"', 1).cast("long").alias("page_id"))
