"""A load of landed price histories into the keyed snapshot table, with a report for each card."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlark.operators import cards
from ledgerlark.operators.match import shared_index
from ledgerlark.operators.numbering import written
from ledgerlark.sources import landing
from ledgerlark.streaming.tables import KeyedTable

KEYS = ["item_id", "source", "grade", "observed_at"]


def load_histories(refs: DataFrame, declared: DataFrame, bodies: DataFrame, meta: DataFrame, catalogue: DataFrame, table: KeyedTable, run: int, source: str, issue_source: str, currency: str) -> DataFrame:
    """Load every card's history and report on it (SC11, SC12, JN10, JN11, PJ16, SE2, SK2, SK3, AG1).

    refs: id (of the listing), card, url; an id of several cards counts only if declared (column id) shared. bodies: card, body, the
    price files; meta: card, body, what was landed beside them. catalogue: source_key (the card), item_id. The report has a row for each
    card of the index: status skipped:no_prices_file, anomaly (with the first fault as note), skipped:not_in_db or loaded; points,
    first_day and last_day of what was read; inserted, corrected and repeated rows of the table.

    A history without points stands back for the issue price of its metadata, one synthetic row under issue_source. Nothing of a
    card that isn't loaded is written. A run that is repeated under its number writes nothing and reports the same.
    """
    index = refs.join(shared_index(refs.select("id", "card"), declared), ["id", "card"], "left_semi").dropDuplicates(["id", "card"])
    files = bodies.join(index.select("card").distinct(), "card", "left_semi")
    points, rejected = landing.histories(files, "card", lambda df: written(df, "judged"))
    held = points.groupBy("card").agg(F.count(F.lit(1)).alias("points"), F.min("day").alias("first_day"), F.max("day").alias("last_day"))
    bare = files.select("card").join(held, "card", "left_anti").join(rejected, "card", "left_anti")
    issued = landing.issue_prices(meta.join(bare, "card", "left_semi"), "card").dropDuplicates(["card"])
    item = index.select("card", "url").dropDuplicates(["card"]).join(catalogue.select(F.col("source_key").alias("card"), "item_id"), "card")
    rows = cards.snapshot_rows(points.join(item, "card"), "item_id", "price", "day", "url", source, currency)
    first = cards.snapshot_rows(issued.join(item, "card"), "item_id", "price", "day", "url", issue_source, currency)
    table.merge(rows.unionByName(first), "load", run)
    n = F.count(F.lit(1))
    changes = table.changes_of("load", run).groupBy("item_id").agg(*(F.count_if(F.col("outcome") == o).alias(o) for o in ("inserted", "corrected", "repeated")))
    issue = issued.groupBy("card").agg(n.alias("issue_rows"), F.min("day").alias("issue_day"))
    told = index.select("id", "card").join(files.groupBy("card").agg(n.alias("files")), "card", "left").join(rejected.select("card", "reason", "at"), "card", "left")
    told = told.join(held, "card", "left").join(issue, "card", "left").join(catalogue.select(F.col("source_key").alias("card"), "item_id"), "card", "left").join(changes, "item_id", "left")
    status = F.when(F.col("files").isNull(), "skipped:no_prices_file").when(F.col("reason").isNotNull(), "anomaly").when(F.col("item_id").isNull(), "skipped:not_in_db").otherwise("loaded")
    note = F.when(F.col("reason").isNotNull(), F.concat_ws(" ", "reason", "at")).when(F.col("issue_rows").isNotNull(), "issue price")
    zero = F.lit(0).cast("long")
    return told.select(
        "id",
        "card",
        status.alias("status"),
        F.coalesce("points", "issue_rows", zero).alias("points"),
        F.coalesce("first_day", "issue_day").alias("first_day"),
        F.coalesce("last_day", "issue_day").alias("last_day"),
        *(F.when(status == "loaded", F.coalesce(o, zero)).otherwise(zero).alias(o) for o in ("inserted", "corrected", "repeated")),
        note.alias("note"),
    )
