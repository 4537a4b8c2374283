"""Preference formatting: one prompt and two masked completions for each pair of conversations.

A pair is a chosen and a rejected conversation; by default conversations 2k and 2k + 1, of which the
even one is chosen. Turns of both sides are counted by (pair, turn, role, text) with partial sums; the
first turn whose rows differ between the sides ends their longest common prefix. Turns before it are
rendered once, as the prompt; the rest of each side is its completion, with the character spans of
the assistant's own text as the loss mask.

Defined results: rows with a null conv_id take no part; a null turn comes before all others, a null
role is rendered as "unknown", a null text as empty; a turn given several times with different rows is
ordered by role, then text, and repeated rows stay as often as they are; a conversation whose partner is missing
has a null completion on that side, and its prompt is empty; other input columns are left out; no
conversations give no rows. A rendered conversation must fit one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rendering of a turn: head, text, tail.
HEAD, AFTER_ROLE, TAIL = "<|im_start|>", "\n", "<|im_end|>\n"
TRAINED_ROLE = "assistant"


def rendered(role: Column, text: Column) -> Column:
    return F.concat(F.lit(HEAD), role, F.lit(AFTER_ROLE), text, F.lit(TAIL))


def default_pair(conv: Column) -> tuple[Column, Column]:
    """Pair id and whether the conversation is the chosen one."""
    return F.floor(conv / F.lit(2)).cast("long"), F.pmod(conv, F.lit(2)) == 0


def spans(turns: Column) -> Column:
    """[start, end) character spans of the trained role's text and tail within the rendered turns."""
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:long,end:long>>").alias("spans"))

    def add(acc: Column, t: Column) -> Column:
        size = F.length(rendered(t["role"], t["text"])).cast("long")
        body = acc["at"] + F.length(F.concat(F.lit(HEAD), t["role"], F.lit(AFTER_ROLE)))
        span = F.array(F.struct(body.cast("long").alias("start"), (acc["at"] + size).cast("long").alias("end")))
        return F.struct((acc["at"] + size).alias("at"), F.when(t["role"] == TRAINED_ROLE, F.concat(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"))

    return F.aggregate(turns, start, add, lambda acc: acc["spans"])


def format_pairs(conversations: DataFrame, pair=default_pair) -> DataFrame:
    """pair_id, chosen_id, rejected_id, n_prompt_turns, prompt, chosen, rejected, chosen_mask, rejected_mask."""
    pair_id, is_chosen = pair(F.col("conv_id"))
    turns = (
        conversations.filter(F.col("conv_id").isNotNull())
        .select(
            pair_id.alias("pair_id"),
            is_chosen.alias("is_chosen"),
            "conv_id",
            F.coalesce(F.col("turn").cast("long"), F.lit(-(2**62))).alias("turn"),
            F.coalesce(F.col("role"), F.lit("unknown")).alias("role"),
            F.coalesce(F.col("text"), F.lit("")).alias("text"),
        )
        .groupBy("pair_id", "turn", "role", "text")
        .agg(
            F.count_if("is_chosen").alias("n_chosen"),
            F.count_if(~F.col("is_chosen")).alias("n_rejected"),
            F.max(F.when(F.col("is_chosen"), F.col("conv_id"))).alias("chosen_id"),
            F.max(F.when(~F.col("is_chosen"), F.col("conv_id"))).alias("rejected_id"),
        )
    )
    whole = turns.groupBy("pair_id").agg(
        F.min(F.when(F.col("n_chosen") != F.col("n_rejected"), F.col("turn"))).alias("apart"),
        F.max("chosen_id").alias("chosen_id"),
        F.max("rejected_id").alias("rejected_id"),
        F.array_sort(F.collect_list(F.struct("turn", "role", "text", "n_chosen", "n_rejected"))).alias("turns"),
    )

    def side(count: str, before: bool) -> Column:
        """This side's turns before or from where the sides part, each as often as it was given."""
        apart = F.col("apart")
        here = F.filter("turns", lambda t: (t[count] > 0) & (apart.isNull() | (t["turn"] < apart) if before else apart.isNotNull() & (t["turn"] >= apart)))
        return F.flatten(F.transform(here, lambda t: F.array_repeat(F.struct(t["role"].alias("role"), t["text"].alias("text")), t[count].cast("int"))))

    def text(turns: str) -> Column:
        return F.array_join(F.transform(turns, lambda t: rendered(t["role"], t["text"])), "")

    cut = whole.select("pair_id", "chosen_id", "rejected_id", side("n_chosen", True).alias("p"), side("n_chosen", False).alias("c"), side("n_rejected", False).alias("r"))
    has = {"c": F.col("chosen_id").isNotNull(), "r": F.col("rejected_id").isNotNull()}
    return cut.select(
        "pair_id",
        "chosen_id",
        "rejected_id",
        F.size("p").cast("long").alias("n_prompt_turns"),
        text("p").alias("prompt"),
        F.when(has["c"], text("c")).alias("chosen"),
        F.when(has["r"], text("r")).alias("rejected"),
        F.when(has["c"], spans(F.col("c"))).alias("chosen_mask"),
        F.when(has["r"], spans(F.col("r"))).alias("rejected_mask"),
    )


#: Masks as text "start-end,start-end", as the query has them.
ORACLE_SQL = """
WITH t AS (
  SELECT CAST(floor(conv_id / 2.0) AS BIGINT) AS pair_id, conv_id % 2 = 0 AS is_chosen, conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL),
g AS (
  SELECT pair_id, turn, role, text, count(*) FILTER (WHERE is_chosen) AS nc, count(*) FILTER (WHERE NOT is_chosen) AS nr FROM t GROUP BY pair_id, turn, role, text),
a AS (SELECT pair_id, min(CASE WHEN nc <> nr THEN turn END) AS apart FROM g GROUP BY pair_id),
x AS (
  SELECT t.pair_id, t.is_chosen, t.conv_id, t.turn, t.role, t.text, a.apart IS NULL OR t.turn < a.apart AS shared,
         '<|im_start|>' || t.role || chr(10) || t.text || '<|im_end|>' || chr(10) AS body
  FROM t JOIN a ON t.pair_id = a.pair_id),
s AS (
  SELECT *, sum(length(body)) OVER (PARTITION BY pair_id, is_chosen, shared ORDER BY turn, role, text ROWS UNBOUNDED PRECEDING) AS upto FROM x)
SELECT pair_id,
  max(CASE WHEN is_chosen THEN conv_id END) AS chosen_id,
  max(CASE WHEN NOT is_chosen THEN conv_id END) AS rejected_id,
  count(CASE WHEN is_chosen AND shared THEN 1 END) AS n_prompt_turns,
  coalesce(string_agg(CASE WHEN is_chosen AND shared THEN body END, '' ORDER BY turn, role, text), '') AS prompt,
  CASE WHEN max(CASE WHEN is_chosen THEN conv_id END) IS NOT NULL THEN coalesce(string_agg(CASE WHEN is_chosen AND NOT shared THEN body END, '' ORDER BY turn, role, text), '') END AS chosen,
  CASE WHEN max(CASE WHEN NOT is_chosen THEN conv_id END) IS NOT NULL THEN coalesce(string_agg(CASE WHEN NOT is_chosen AND NOT shared THEN body END, '' ORDER BY turn, role, text), '') END AS rejected,
  CASE WHEN max(CASE WHEN is_chosen THEN conv_id END) IS NOT NULL THEN coalesce(string_agg(CASE WHEN is_chosen AND NOT shared AND role = 'assistant' THEN CAST(upto - length(text) - 11 AS VARCHAR) || '-' || CAST(upto AS VARCHAR) END, ',' ORDER BY turn, role, text), '') END AS chosen_mask,
  CASE WHEN max(CASE WHEN NOT is_chosen THEN conv_id END) IS NOT NULL THEN coalesce(string_agg(CASE WHEN NOT is_chosen AND NOT shared AND role = 'assistant' THEN CAST(upto - length(text) - 11 AS VARCHAR) || '-' || CAST(upto AS VARCHAR) END, ',' ORDER BY turn, role, text), '') END AS rejected_mask
FROM s GROUP BY pair_id
"""
