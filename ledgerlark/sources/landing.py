"""Landed input as tables, and the layout that sinks write.

Layout: landing/<kind>/<name> verbatim, tables/<name>/snapshot=<n>, side outputs anomalies/, unmatched/, outcomes/.
Explicit globs are used throughout: Spark's recursive listing skips names that begin with an underscore.
"""

from __future__ import annotations

from base64 import b64decode
from collections.abc import Callable, Iterator
from urllib.parse import unquote

import pyarrow as pa
from pyarrow.fs import FileSystem, LocalFileSystem
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerlark.functions import text, values
from ledgerlark.functions.text import let
from ledgerlark.operators.numbering import dealt
from ledgerlark.sources.folders import Folders

# Fields of the rate archive.
RATE_SCHEMA = "array<struct<exchangedate string, cc string, rate_per_unit decimal(14,6)>>"


def pages(spark: SparkSession, pattern: str, names: str | None = None) -> DataFrame:
    """(path, html) of landed pages, one row a file (SC1, SC3, SC8).

    Many pages of a folder are read as the folder with `names`, a glob of the files' names: it is listed once, and no path is looked up by itself.
    """
    reader = spark.read if names is None else spark.read.option("pathGlobFilter", names)
    return reader.text(pattern, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("html"))


def page_of(path: Column) -> tuple[Column, Column]:
    """(locale, page number) of a landed listing page, <locale>_p<number>.html: pages sort by number, not by name (SC8)."""
    return tuple(F.nullif(F.regexp_extract(path, r"([^/]+)_p(\d+)\.html(?:/[^/]*)?$", i), F.lit("")) for i in (1, 2))


def write_named(rows: DataFrame, name: str, body: str, root: str) -> None:
    """The bodies of each name, at the path that the name is below root, from one job (SC8, SC9, SK11); names are few.

    A name's folder is moved to its place, so `root`/a/b.json is a folder with a part for each of its rows, mostly one, which every reader
    takes as it would a file.
    """
    spark, staging = rows.sparkSession, f"{root}/_staging"
    rows.select(F.base64(F.encode(F.col(name), "UTF-8")).alias("__name"), F.col(body).alias("value")).withColumn("__name", F.translate("__name", "/+=", "_-.")).repartition("__name").write.mode("overwrite").option("maxRecordsPerFile", 1).partitionBy("__name").text(staging)
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path
    files = path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for status in files.listStatus(path(staging)):
        if status.isDirectory():
            told = unquote(status.getPath().getName().split("=", 1)[1])
            place = path(root, b64decode(told.translate(str.maketrans("_-.", "/+="))).decode())
            files.mkdirs(place.getParent())
            files.delete(place, True)
            files.rename(status.getPath(), place)
    files.delete(path(staging), True)


def write_files(rows: DataFrame, name: str, body: str, root: str) -> DataFrame:
    """(name, bytes) of the bodies, each one file at the path that its name is below root, however many there are (SC8); names are unique.

    Tasks write them, and the driver touches none. A file that is written again replaces the first. The writing is done when the result is
    used, and again if it is used again. root is an address that pyarrow's file systems open.
    """
    target = root if ":" in root else f"file://{root}"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, top = FileSystem.from_uri(target)
        made = set()
        for batch in batches:
            sizes = []
            for row in batch.to_pylist():
                to, data = f"{top}/{row['name']}", (row["body"] or "").encode()
                if isinstance(store, LocalFileSystem) and (folder := to.rsplit("/", 1)[0]) not in made:
                    store.create_dir(folder, recursive=True)
                    made.add(folder)
                with store.open_output_stream(to) as out:
                    out.write(data)
                sizes.append(len(data))
            yield pa.RecordBatch.from_arrays([batch.column("name"), pa.array(sizes, pa.int64())], names=["name", "bytes"])

    return dealt(rows.select(F.col(name).alias("name"), F.col(body).alias("body"))).mapInArrow(work, "name string, bytes long")


def year_of(path: Column) -> Column:
    return F.regexp_extract(path, r"(\d{4})\.html$", 1).try_cast("int")


def run_day_of(path: Column) -> Column:
    """The run's day of a daily landing folder (SC4)."""
    return F.try_to_date(F.regexp_extract(path, r"run_date=(\d{4}-\d{2}-\d{2})", 1), "yyyy-MM-dd")


def documents(spark: SparkSession, pattern: str | list[str], schema: str) -> DataFrame:
    """(path, fields) of landed JSON documents under an explicit schema (SC9)."""
    return spark.read.schema(schema).option("multiLine", True).json(pattern).select(F.col("_metadata.file_path").alias("path"), "*")


def series_cards(spark: SparkSession, country: str, series: str | None = None, card: str = "source_id string, listing struct<id:long,url:string>") -> DataFrame:
    """(series, card fields) of the parsed cards of every series below a country's folder, or of one (SC10).

    The series is the folder's name; folders that begin with an underscore are shared caches, not series. No folder gives no rows.
    """
    spark_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{country}/{series or '[^_]*'}/parsed/cards.json")
    files = spark_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    schema = f"cards array<struct<{', '.join(f.strip().replace(' ', ':', 1) for f in split_fields(card))}>>"
    found = [str(s.getPath()) for s in files.globStatus(spark_path) or []]  # a folder a series
    if not found:
        return spark.createDataFrame([], f"series string, {card}")
    rows = documents(spark, found, schema)
    return rows.select(F.regexp_extract("path", r"/([^/]+)/parsed/cards\.json", 1).alias("series"), F.explode("cards").alias("c")).select("series", "c.*")


def split_fields(ddl: str) -> list[str]:
    """The fields of a DDL schema, cut at commas outside of angle brackets."""
    out, depth = [""], 0
    for c in ddl:
        depth += (c == "<") - (c == ">")
        if c == "," and not depth:
            out.append("")
        else:
            out[-1] += c
    return out


def rates(bodies: DataFrame, currency: str) -> DataFrame:
    """(currency, day, rate) of archive bodies; rows of another currency are dropped, decimals stay exact (SC7, FL5)."""
    rows = bodies.select(F.inline(F.from_json("body", RATE_SCHEMA)))
    return rows.filter(F.col("cc") == currency).select(F.col("cc").alias("currency"), F.try_to_date("exchangedate", "dd.MM.yyyy").alias("day"), F.col("rate_per_unit").alias("rate"))


def points(bodies: DataFrame, key: str) -> DataFrame:
    """(key, pos, day, raw_day, price, is_list) of price histories, point by point; a body that is no list has one row with is_list false (FN18).

    Nothing is rejected here; histories() judges whole bodies.
    """
    parsed = bodies.select(key, F.try_parse_json("body").alias("v")).withColumn("is_list", F.coalesce(F.schema_of_variant("v").startswith("ARRAY"), F.lit(False)))
    items = F.when(F.col("is_list"), F.try_variant_get("v", "$", "array<variant>"))
    rows = parsed.select(key, "is_list", F.posexplode_outer(items).alias("pos", "value"))
    raw = F.try_variant_get("value", "$.date", "string")
    return rows.select(key, "pos", values.iso_date(F.trim(raw)).alias("day"), raw.alias("raw_day"), values.point_price(F.col("value")).alias("price"), "is_list")


def read_point(value: Column) -> Column:
    """struct(day, price, early, late) of a VARIANT point: what is wrong with it before and after its day is compared with the last one's.

    Reasons, in order: object, keys, date type, date; then boolean, number, positive, size. Null is sound.
    """
    def judged(date: Column, price: Column) -> Column:
        date_kind, price_kind = F.schema_of_variant(date), F.schema_of_variant(price)
        day = values.iso_date(text.trim(F.when(date_kind == "STRING", F.try_variant_get(date, "$", "string"))))
        exact, near = values.variant_number(price), F.try_variant_get(price, "$", "double")
        early = (
            F.when(~F.schema_of_variant(value).startswith("OBJECT"), "object")
            .when(date.isNull() | price.isNull(), "keys")
            .when(date_kind != "STRING", "date type")
            .when(day.isNull(), "date")
        )
        # A number beyond the exact type's range is positive or not by its double; a tiny one isn't zero.
        late = (
            F.when(price_kind == "BOOLEAN", "boolean")
            .when(~price_kind.rlike(values.NUMBER_KINDS) & (price_kind != "STRING"), "number")
            .when(exact.isNull() & (near.isNull() | (price_kind == "STRING")), "number")
            .when(F.coalesce(near, exact.cast("double")) <= 0, "positive")
            .when(exact.isNull() | (exact >= values.MOST_PRICE), "size")
        )
        return F.struct(day.alias("day"), exact.alias("price"), early.alias("early"), late.alias("late"))

    return let(F.struct(F.try_variant_get(value, "$.date", "variant").alias("d"), F.try_variant_get(value, "$.price", "variant").alias("p")), lambda x: judged(x["d"], x["p"]))


def first_fault(read: Column) -> Column:
    """struct(reason, at) of the first point that is unsound or whose day isn't after the last one's, in one ordered fold (WN1, WN2)."""
    start = F.struct(F.lit(0).alias("at"), F.lit(None).cast("date").alias("last"), F.lit(None).cast("string").alias("reason"))

    def step(acc: Column, p: Column) -> Column:
        reason = F.coalesce(p["early"], F.when(p["day"] <= acc["last"], "order"), p["late"])
        following = F.struct((acc["at"] + F.when(reason.isNull(), 1).otherwise(0)).alias("at"), p["day"].alias("last"), reason.alias("reason"))
        return F.when(acc["reason"].isNotNull(), acc).otherwise(following)

    return F.aggregate(read, start, step, lambda acc: F.struct(acc["reason"].alias("reason"), F.when(acc["reason"].isNotNull(), acc["at"]).alias("at")))


def histories(bodies: DataFrame, key: str, save: Callable[[DataFrame], DataFrame] = lambda df: df) -> tuple[DataFrame, DataFrame]:
    """(points, rejected) of whole price histories, one JSON body a row (SC11, WN1, WN2, FL4, FN18).

    points: key, pos, day, price (exact), raw (the point's JSON) of bodies all of whose points are sound and in strictly rising order of
    days; a list without points has none and isn't rejected. rejected: key, reason, at (the failing point's position; null if the body
    itself fails), one row a body. A body that is no JSON (also one that repeats a name in an object) fails as "json", one that is no
    list as "list". Bodies are dealt to all cores and each is judged by itself. save may write the judged bodies down, so that both results
    come from one reading of them.
    """
    parsed = dealt(bodies.select(key, "body")).select(key, F.try_parse_json("body").alias("v"))
    kind = F.schema_of_variant("v")
    whole = F.when(F.col("v").isNull(), "json").when(~kind.startswith("ARRAY"), "list")
    items = F.when(kind.startswith("ARRAY"), F.try_variant_get("v", "$", "array<variant>"))
    read = parsed.select(key, whole.alias("whole"), items.alias("items")).withColumn("read", F.transform("items", read_point))
    told = read.withColumn("fault", F.when(F.col("whole").isNull(), first_fault(F.col("read"))))
    reason = F.coalesce("whole", "fault.reason")
    # What a rejected body held isn't kept.
    kept = {"read": F.transform("read", lambda p: F.struct(p["day"].alias("day"), p["price"].alias("price"))), "raw": F.transform("items", lambda v: F.to_json(v))}
    judged = save(told.select(key, reason.alias("reason"), F.when(F.col("whole").isNull(), F.col("fault.at")).alias("at"), *(F.when(reason.isNull(), c).alias(n) for n, c in kept.items())))
    sound = judged.filter("reason is null").select(key, F.posexplode(F.arrays_zip("read", "raw")).alias("pos", "p"))
    return sound.select(key, "pos", F.col("p.read.day").alias("day"), F.col("p.read.price").alias("price"), F.col("p.raw").alias("raw")), judged.filter("reason is not null").select(key, "reason", "at")


def issue_prices(bodies: DataFrame, key: str, field: str = "issue_price") -> DataFrame:
    """The issue price of landed metadata; any malformed field gives no row (SC12)."""
    meta = F.from_json("body", f"{field} struct<price string, date string, text string>")[field]
    out = bodies.select(key, meta["price"].try_cast("decimal(14,2)").alias("price"), F.try_to_date(meta["date"], "yyyy-MM-dd").alias("day"), meta["text"].alias("text"))
    return out.filter("price > 0 and day is not null")


def stale(meta: DataFrame, match: DataFrame, key: str, meta_id: str, match_id: str) -> DataFrame:
    """Keys whose landed history was fetched for another id than the current match (SC6)."""
    return match.join(meta.select(F.col(key).alias("__k"), F.col(meta_id).alias("__m")), F.col(key) == F.col("__k"), "left").filter(~F.col(match_id).eqNullSafe(F.col("__m"))).select(key)


def images(spark: SparkSession, pattern: str) -> DataFrame:
    """Decoded images; a file that can't be read is a rejected row, not a failure (SC15)."""
    read = spark.read.format("image").option("dropInvalid", False).load(pattern).select("image.*")
    return read.withColumn("readable", F.col("height") > 0)


def write_snapshot(df: DataFrame, root: str, name: str, number: int) -> str:
    """A table's next state as its own folder (SK1, SK11); it can't be written twice."""
    path = f"{root}/tables/{name}/snapshot={number}"
    df.write.mode("errorifexists").parquet(path)
    return path


def read_snapshot(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A table as of its last snapshot that was written to its end; there must be one."""
    numbers = [int(n.split("=")[1]) for n in Folders(spark, f"{root}/tables/{name}").complete() if n.startswith("snapshot=")]
    return spark.read.parquet(f"{root}/tables/{name}/snapshot={max(numbers)}")


def write_side(df: DataFrame, root: str, kind: str, run: str) -> None:
    """Anomalies, unmatched rows and outcomes of a run, apart from its result (SK11)."""
    df.write.mode("overwrite").json(f"{root}/{kind}/run={run}")


def read_side(spark: SparkSession, root: str, kind: str, schema: str) -> DataFrame:
    """A kind's side outputs of all runs, with the run's name."""
    rows = spark.read.schema(schema).json(f"{root}/{kind}/run=*")
    return rows.select("*", F.regexp_extract(F.col("_metadata.file_path"), "run=([^/]+)/", 1).alias("run"))


def write_pages(fetched: DataFrame, root: str, kind: str, run: str) -> str:
    """Fetched pages as they came, one row a page: name and body (SK12); a second write of a run replaces the first."""
    path = f"{root}/landing/{kind}/run={run}"
    fetched.select("name", "body").write.mode("overwrite").json(path)
    return path


def read_pages(spark: SparkSession, root: str, kind: str, run: str = "*") -> DataFrame:
    """(name, body, run) of landed pages, of one run or of all."""
    rows = spark.read.schema("name string, body string").json(f"{root}/landing/{kind}/run={run}")
    return rows.select("name", "body", F.regexp_extract(F.col("_metadata.file_path"), "run=([^/]+)/", 1).alias("run"))


def prune(spark: SparkSession, root: str, today: str, keep: int = 14) -> list[str]:
    """Delete daily folders older than `keep` days under a root and return their names; other names are left alone (SK13, ST5)."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in files.listStatus(path) if s.isDirectory()]
    gone = [r["name"] for r in expired(spark.createDataFrame([(n,) for n in names], "name string"), today, keep).collect()]
    for name in gone:
        files.delete(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root, name), True)
    return sorted(gone)


def recheck(landed: DataFrame, key: str, html: str, own_id: str) -> DataFrame:
    """(key, price, day, found_by, path) of landed pages, without fetching them again (SC5, SC6): the stated price and the chart's address."""
    from ledgerlark.sources import markup

    said = markup.extracted(landed, key, html, markup.current_prices, markup.PRICE_SCHEMA).select(key, "price", "day", "found_by")
    found = markup.extracted(landed, key, html, markup.endpoints, markup.ENDPOINT_SCHEMA).join(landed.select(key, own_id), key)
    return landed.select(key).join(said, key, "left").join(markup.chosen_endpoint(found, key, F.col(own_id)).select(key, "path"), key, "left")


def expired(days: DataFrame, today: str, keep: int = 14) -> DataFrame:
    """Names of daily folders older than `keep` days; names that are no day are left alone (SK13, ST5)."""
    parsed = F.try_to_date("name", "yyyy-MM-dd")
    return days.filter(parsed < F.date_sub(F.lit(today).cast("date"), keep)).select("name")


def first_occurrences(df: DataFrame, key: str, pos: str, last: bool = False) -> DataFrame:
    """The first (or last) row of each id in reading order (AG15)."""
    order = F.col(pos).desc() if last else F.col(pos).asc()
    return df.withColumn("__rn", F.row_number().over(Window.partitionBy(key).orderBy(order))).filter("__rn = 1").drop("__rn")


# Content types of the files that are uploaded, by extension.
CONTENT_TYPES = {".png": "image/png", ".jpg": "image/jpeg", ".jpeg": "image/jpeg", ".webp": "image/webp", ".html": "text/html", ".json": "application/json"}


def upload(files: DataFrame, target: str, types: dict[str, str] | None = None) -> DataFrame:
    """(key, content_type, bytes) of files copied to an object store or folder under their keys (SK14).

    files: path, key. Files whose extension has no content type stay behind. Tasks copy, in the order of keys and a megabyte at a time; a
    copy that is done again replaces the first. path and target are addresses that pyarrow's file systems open.
    """
    known = types or CONTENT_TYPES
    extension = F.lower(F.regexp_extract("key", r"(\.[^./]+)$", 1))
    kind = F.create_map(*(F.lit(x) for pair in known.items() for x in pair))[extension]
    wanted = files.select("path", "key", kind.alias("content_type")).filter("content_type is not null").repartitionByRange("key").sortWithinPartitions("key")
    schema = pa.schema([("key", pa.string()), ("content_type", pa.string()), ("bytes", pa.int64())])

    def copied(path: str, key: str, content_type: str) -> int:
        (source, at), (store, to) = FileSystem.from_uri(path), FileSystem.from_uri(f"{target}/{key}")
        if isinstance(store, LocalFileSystem):
            store.create_dir(to.rsplit("/", 1)[0], recursive=True)
        n = 0
        with source.open_input_stream(at) as given, store.open_output_stream(to, metadata={"Content-Type": content_type}) as taken:
            while piece := given.read(1 << 20):
                taken.write(piece)
                n += len(piece)
        return n

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            sizes = [copied(r["path"], r["key"], r["content_type"]) for r in rows]
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("content_type"), pa.array(sizes, pa.int64())], schema=schema)

    return wanted.mapInArrow(work, "key string, content_type string, bytes long")
