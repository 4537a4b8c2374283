"""Exact dedup by progressive refinement: length, then the hash of the beginning, then the hash of the whole text.

Texts are equal when they are identical after each run of ASCII white space is replaced by one blank. A first pass reduces each
row to its normalised length and the hash of its first characters. Lengths that only one row has are out; among the rest the pairs of
length and beginning that only one row has are. What survives is marked in a bit map of bounded size, against which a second pass
decides row by row whether the whole text is hashed: a bit that two keys share makes a text hashed in vain, never grouped wrongly.
Groups are formed by length and SHA-256. No text is shuffled; a large group of copies is pre-aggregated and joined by broadcast.

Defined results: a null text counts as empty, so empty and null texts are one group, while a text of white space alone is a blank;
of equal texts the row with the smallest id stays, a null id after all others; of rows that repeat that id too, one stays;
other columns are left out by mark(), so names can't clash, and kept as they are by keep_one(); no documents give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlark.llm.common import Scratch, spread_join

#: Characters of the beginning that is hashed.
BEGINNING = 64
#: Bits a surviving key, and the largest map: 2**20 words of 64 bits, 8 MB.
BITS_A_KEY, MOST_WORDS = 16, 1 << 20


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def bit_map(keys: DataFrame, key: str, words: int) -> DataFrame:
    """One row: the keys (longs) as bits of an array of `words` longs, a power of two."""
    bit = F.pmod(F.col(key), F.lit(64 * words))
    held = keys.groupBy(F.shiftright(bit, 6).alias("__word")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast(pmod({key}, 64) as int))")).alias("__bits"))
    every = keys.sparkSession.range(words).join(held, F.col("id") == F.col("__word"), "left")
    return every.agg(F.transform(F.array_sort(F.collect_list(F.struct("id", F.coalesce("__bits", F.lit(0).cast("long")).alias("bits")))), lambda w: w["bits"]).alias("__map"))


def in_map(key: Column, words: int) -> Column:
    """Whether a key's bit is set in the column __map."""
    word = F.get("__map", F.shiftright(F.pmod(key, F.lit(64 * words)), 6).cast("int"))
    return F.getbit(word, F.pmod(key, F.lit(64)).cast("int")) != 0


def words_for(n: int) -> int:
    """Words of a map for n keys: a power of two."""
    return min(MOST_WORDS, 1 << max(10, (n * BITS_A_KEY // 64).bit_length()))


def _marked(docs: DataFrame, id: str, text: str, carried: list[Column]) -> DataFrame:
    """__id, carried columns, __best (of the row that stays), __n, __row of each document."""
    scratch = Scratch(docs.sparkSession, "exact-dedup")
    whole = normalised(F.col(text))
    heads = scratch.save(docs.select(whole.alias("__t")).select(F.length("__t").cast("long").alias("__len"), F.xxhash64(F.left("__t", F.lit(BEGINNING))).alias("__head")), "heads")
    # Level 1: lengths of several rows.
    lengths = heads.groupBy("__len").agg(F.count(F.lit(1)).alias("__n")).filter("__n > 1")
    n = words_for(lengths.count())
    alike = heads.crossJoin(F.broadcast(bit_map(lengths, "__len", n))).filter(in_map(F.col("__len"), n))  # one row
    # Level 2: beginnings of several rows of a length.
    pairs = scratch.save(alike.groupBy("__len", "__head").agg(F.count(F.lit(1)).alias("__n")).filter("__n > 1").select(F.xxhash64("__len", "__head").alias("__key")), "pairs")
    n = words_for(pairs.count())
    survives = in_map(F.xxhash64("__len", F.xxhash64(F.left("__t", F.lit(BEGINNING)))), n)
    told = docs.select(F.col(id).alias("__id"), *carried, whole.alias("__t")).withColumn("__len", F.length("__t").cast("long")).crossJoin(F.broadcast(bit_map(pairs, "__key", n)))  # one row
    # Level 3: the whole text, of survivors alone.
    rows = scratch.save(told.withColumns({"__full": F.when(survives, F.unhex(F.sha2("__t", 256))), "__row": F.monotonically_increasing_id()}).drop("__t", "__map"), "rows")
    scratch.drop("heads")
    keys, open_rows = ["__len", "__full"], rows.filter("__full is not null")
    groups = scratch.save(open_rows.groupBy(*keys).agg(F.min(F.struct(F.col("__id").isNull().alias("none"), F.col("__id").alias("id"), F.col("__row").alias("row"))).alias("__best"), F.count(F.lit(1)).alias("__n")).filter("__n > 1"), "groups")
    joined = spread_join(open_rows, groups, keys, "__n", rows.count(), "left")
    return joined.unionByName(rows.filter("__full is null"), allowMissingColumns=True).drop(*keys)


def mark(docs: DataFrame, id: str = "doc_id", text: str = "text", digests: dict[str, Column] | None = None) -> DataFrame:
    """id, keep_id (of the row that stays), group_size, kept of each document, and what `digests` derives of it.

    digests: names and narrow expressions over the documents' columns, for instance of normalised(text).
    """
    digests = digests or {}
    found = _marked(docs, id, text, [c.alias(n) for n, c in digests.items()])
    several = F.col("__n").isNotNull()
    return found.select(
        F.col("__id").alias(id),
        F.when(several, F.col("__best.id")).otherwise(F.col("__id")).alias("keep_id"),
        F.coalesce("__n", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce(F.col("__best.row") == F.col("__row"), F.lit(True)).alias("kept"),
        *digests,
    )


def keep_one(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents without the copies, with all their columns."""
    found = _marked(docs, id, text, [F.struct("*").alias("__doc")])
    return found.filter("__best is null or __best.row = __row").select("__doc.*")


ORACLE_SQL = r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
  doc_id = min(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256 FROM t
"""
