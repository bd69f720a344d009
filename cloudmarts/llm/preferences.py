"""Preference formatting: chosen and rejected conversations with one shared prompt.

The longest common prefix of turns (role and text) is rendered once as the prompt; what
follows on either side is rendered as a completion with a mask that trains the assistant's
turns only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

END = "<|end|>\n"


def _head(role: Column) -> Column:
    return F.concat(F.lit("<|"), role, F.lit("|>\n"))


def _turns(side: DataFrame, name: str) -> DataFrame:
    """pair_id and its turns in order.  A pair's turns are one training record."""
    turn = F.struct(F.col("turn"), F.coalesce(F.col("role").cast("string"), F.lit("unknown")).alias("role"),
                    F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return (side.where(F.col("pair_id").isNotNull()).groupBy("pair_id")
            .agg(F.sort_array(F.collect_list(turn)).alias(name)))


def _render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(_head(t["role"]), t["text"], F.lit(END))), "")


def _mask(turns: Column) -> Column:
    """start:end of what is trained in the rendered turns: text and end mark of every
    assistant turn, in code points, end exclusive."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("spans"))

    def add(acc: Column, t: Column) -> Column:
        first = acc["at"] + F.char_length(_head(t["role"]))
        last = first + F.char_length(t["text"]) + len(END)
        span = F.concat(first.cast("string"), F.lit(":"), last.cast("string"))
        return F.struct(last.alias("at"), F.when(t["role"] == "assistant", F.concat(acc["spans"], F.array(span)))
                        .otherwise(acc["spans"]).alias("spans"))

    return F.array_join(F.aggregate(turns, start, add, lambda acc: acc["spans"]), ",")


def format_preferences(chosen: DataFrame, rejected: DataFrame) -> DataFrame:
    """(pair_id, turn, role, text) of both sides -> one row per pair: pair_id, n_common,
    prompt, chosen, rejected, chosen_mask, rejected_mask.

    Turns go by turn number, then role, then text, so repeated rows stay and ties are
    settled; null roles read "unknown", null texts are empty; rows without a pair are left
    out; a side that is missing is an empty conversation; an empty table gives an empty
    result; other columns are not read.
    """
    both = _turns(chosen, "c").join(_turns(rejected, "r"), "pair_id", "full").select(
        "pair_id", *[F.coalesce(F.col(s), F.array().cast(_TURNS)).alias(s) for s in "cr"])
    same = F.zip_with("c", "r", lambda a, b: F.coalesce((a["role"] == b["role"]) & (a["text"] == b["text"]), F.lit(False)))
    first_difference = F.array_position(same, F.lit(False)).cast("int")
    n = F.when(first_difference > 0, first_difference - 1).otherwise(F.size("c"))
    cut = both.withColumn("n_common", n).select(
        "pair_id", "n_common", F.slice("c", F.lit(1), F.col("n_common")).alias("p"),
        *[F.expr(f"slice({s}, n_common + 1, size({s}))").alias(s) for s in "cr"])
    return cut.select("pair_id", "n_common", _render(F.col("p")).alias("prompt"),
                      _render(F.col("c")).alias("chosen"), _render(F.col("r")).alias("rejected"),
                      _mask(F.col("c")).alias("chosen_mask"), _mask(F.col("r")).alias("rejected_mask"))


_TURNS = "array<struct<turn:bigint,role:string,text:string>>"


def swapped_answers(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pairs from a plain table of conversations: every conversation is the chosen side of its
    own pair; the rejected side keeps the turns before its last assistant turn and then gives
    the last answer of the partner, the conversation whose id differs in the lowest bit (no
    partner or no answer there: nothing follows; no assistant turn here: all turns are kept)."""
    turns = conversations.select(F.col("conv_id").cast("long").alias("pair_id"),
                                 F.col("turn").cast("long").alias("turn"), "role", "text")
    last = (turns.where("role = 'assistant'").groupBy("pair_id")
            .agg(F.max(F.struct("turn", "text")).alias("last")))
    convs = turns.groupBy("pair_id").agg(F.max("turn").alias("end"))
    before = turns.join(last.select("pair_id", F.col("last.turn").alias("stop")), "pair_id", "left").where(
        "stop IS NULL OR turn < stop OR turn IS NULL").select("pair_id", "turn", "role", "text")
    other = last.select(F.col("pair_id").bitwiseXOR(F.lit(1)).alias("pair_id"), F.col("last.text").alias("text"))
    answer = (convs.join(last.select("pair_id", F.col("last.turn").alias("stop")), "pair_id", "left")
              .join(other, "pair_id")
              .select("pair_id", F.coalesce("stop", F.col("end") + 1).alias("turn"),
                      F.lit("assistant").alias("role"), "text"))
    return turns, before.union(answer)


def oracle_sql() -> str:
    """format_preferences over swapped_answers in DuckDB's SQL."""
    sides = []
    for side, table in (("c", "t"), ("r", "rej")):
        sides.append(f"""
{side} AS (SELECT *, row_number() OVER (PARTITION BY pair_id ORDER BY turn, role, text) AS pos,
             '<|' || role || '|>' || chr(10) AS head FROM {table}),
{side}_done AS (
  SELECT pair_id, string_agg(whole, '' ORDER BY pos) AS body,
         string_agg(CASE WHEN role = 'assistant'
                         THEN (upto - length(whole) + length(head))::VARCHAR || ':' || upto::VARCHAR END, ',' ORDER BY pos) AS mask
  FROM (SELECT *, sum(length(whole)) OVER (PARTITION BY pair_id ORDER BY pos) AS upto
        FROM (SELECT {side}.*, head || text || '<|end|>' || chr(10) AS whole
              FROM {side} JOIN common USING (pair_id) WHERE pos > n_common))
  GROUP BY pair_id)""")
    (c, c_done), (r, r_done) = [s.split(f",\n{k}_done AS", 1) for s, k in zip(sides, "cr", strict=True)]
    return f"""
WITH t AS (SELECT conv_id AS pair_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text
           FROM conversations WHERE conv_id IS NOT NULL),
last AS (SELECT pair_id, max(turn) AS stop, arg_max(text, turn) AS answer FROM t WHERE role = 'assistant' GROUP BY pair_id),
rej AS (SELECT t.* FROM t LEFT JOIN last USING (pair_id) WHERE stop IS NULL OR turn < stop
        UNION ALL
        SELECT e.pair_id, coalesce(l.stop, e.final + 1), 'assistant', o.answer
        FROM (SELECT pair_id, max(turn) AS final FROM t GROUP BY pair_id) e
        LEFT JOIN last l ON l.pair_id = e.pair_id JOIN last o ON o.pair_id = xor(e.pair_id, 1)),{c},{r},
common AS (
  SELECT pair_id, coalesce(min(CASE WHEN same THEN NULL ELSE pos END) - 1, count(*)) AS n_common
  FROM (SELECT coalesce(c.pair_id, r.pair_id) AS pair_id, coalesce(c.pos, r.pos) AS pos,
               coalesce(c.role = r.role AND c.text = r.text, false) AS same
        FROM c FULL JOIN r ON c.pair_id = r.pair_id AND c.pos = r.pos)
  GROUP BY pair_id),
c_done AS{c_done},
r_done AS{r_done},
p_done AS (SELECT pair_id, string_agg(head || text || '<|end|>' || chr(10), '' ORDER BY pos) AS body
           FROM c JOIN common USING (pair_id) WHERE pos <= n_common GROUP BY pair_id)
SELECT common.pair_id, CAST(n_common AS INTEGER) AS n_common, coalesce(p_done.body, '') AS prompt,
       coalesce(c_done.body, '') AS chosen, coalesce(r_done.body, '') AS rejected,
       coalesce(c_done.mask, '') AS chosen_mask, coalesce(r_done.mask, '') AS rejected_mask
FROM common LEFT JOIN p_done USING (pair_id) LEFT JOIN c_done USING (pair_id) LEFT JOIN r_done USING (pair_id)"""
