"""Preference formatting of chosen and rejected conversations.

Both sides are tables of turns (pair_id, turn, role, text).  The turns that
both conversations share from the beginning on are the prompt, rendered once;
what follows on either side is its completion.  Each turn is rendered in the
ChatML layout; ``loss`` marks what a model is trained on: the assistant's
turns of the completions.

The result has one row per rendered turn, in the order (part, turn, ord), so
that no conversation, however long, has to fit one task: sides meet turn by
turn, and the end of the prefix is a minimum per pair.  ``examples`` joins the
rows of each pair where conversations are known to fit a row.

Edge cases: turns go by number, and equal numbers by role and text; a null
text or role is rendered empty, and equals another null; equal conversations
are all prompt; a pair with one side has no prompt; null pair ids form one
pair; the markers of the layout inside of a text are broken up with a space.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# fixed values of the ChatML layout
BEGIN, END = "<|im_start|>", "<|im_end|>"


def render(role: Column, text: Column) -> Column:
    """One turn in ChatML."""
    clean = F.regexp_replace(F.coalesce(text, F.lit("")), r"<\|im_", "<| im_")
    return F.concat(F.lit(BEGIN), F.coalesce(role, F.lit("")), F.lit("\n"), clean, F.lit(END + "\n"))


def _numbered(turns: DataFrame, side: str) -> DataFrame:
    """Turns of one side; ``ord`` tells turns of equal number apart."""
    same = Window.partitionBy("pair_id", "turn").orderBy("role", "text")
    return (turns.select("pair_id", "turn", "role", "text")
            .withColumn("ord", F.row_number().over(same).cast("long") - 1)
            .select(F.col("pair_id").alias(f"{side}_pair"), F.col("turn").alias(f"{side}_turn"), F.col("ord").alias(f"{side}_ord"),
                    F.struct("role", "text").alias(side)))


def format_preferences(chosen: DataFrame, rejected: DataFrame) -> DataFrame:
    """pair_id, part (prompt, chosen, rejected), turn, ord, role, rendered, loss."""
    a, b = _numbered(chosen, "a"), _numbered(rejected, "b")
    sides = a.join(b, F.col("a_pair").eqNullSafe(F.col("b_pair")) & F.col("a_turn").eqNullSafe(F.col("b_turn"))
                   & (F.col("a_ord") == F.col("b_ord")), "full_outer")
    here = F.col("a_ord").isNotNull()
    sides = sides.select(
        F.when(here, F.col("a_pair")).otherwise(F.col("b_pair")).alias("pair_id"),
        F.when(here, F.col("a_turn")).otherwise(F.col("b_turn")).alias("turn"),
        F.coalesce("a_ord", "b_ord").alias("ord"), "a", "b")
    place = F.struct("turn", "ord")
    alike = F.col("a").eqNullSafe(F.col("b"))
    ends = (sides.groupBy(F.col("pair_id").alias("end_pair")).agg(F.min(F.when(~alike, place)).alias("first_other")))
    parts = sides.join(ends, F.col("pair_id").eqNullSafe(F.col("end_pair")))
    shared = F.coalesce(place < F.col("first_other"), F.lit(True))
    entry = lambda part, side: F.struct(F.lit(part).alias("part"), F.col(side).alias("said"))
    rows = F.when(shared, F.array(entry("prompt", "a"))).otherwise(F.array(entry("chosen", "a"), entry("rejected", "b")))
    return (parts.select("pair_id", "turn", "ord", F.explode(rows).alias("row")).where(F.col("row.said").isNotNull())
            .select("pair_id", "row.part", "turn", "ord", "row.said.role", render(F.col("row.said.role"), F.col("row.said.text")).alias("rendered"),
                    F.coalesce((F.col("row.part") != "prompt") & (F.col("row.said.role") == "assistant"), F.lit(False)).alias("loss")))


def examples(rows: DataFrame) -> DataFrame:
    """pair_id, prompt, chosen, rejected, and for either completion the
    rendered turns with their mask.  For conversations that fit a row."""
    turn = F.struct("turn", "ord", "rendered", "loss")
    lists = rows.groupBy("pair_id").agg(*[F.array_sort(F.collect_list(F.when(F.col("part") == p, turn))).alias(p)
                                          for p in ("prompt", "chosen", "rejected")])
    joined = lambda p: F.array_join(F.transform(p, lambda t: t["rendered"]), "").alias(p)
    masked = lambda p: F.transform(p, lambda t: F.struct(t["rendered"].alias("text"), t["loss"].alias("loss"))).alias(f"{p}_parts")
    return lists.select("pair_id", joined("prompt"), joined("chosen"), joined("rejected"), masked("chosen"), masked("rejected"))


def conversation_pairs(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Chosen and rejected sides made of (conv_id, turn, role, text).

    Every conversation is chosen; its rejected side ends at the last assistant
    turn, answered there with what the assistant says at that turn of the
    conversation with the next id (the empty text if it says nothing there).
    """
    chosen = turns.select(F.col("conv_id").alias("pair_id"), "turn", "role", "text")
    spoken = turns.where(F.col("role") == "assistant")
    last = spoken.groupBy(F.col("conv_id").alias("last_conv")).agg(F.max("turn").alias("last_turn"))
    answers = (spoken.groupBy((F.col("conv_id") - 1).alias("for_conv"), F.col("turn").alias("for_turn"))
               .agg(F.min("text").alias("answer")))
    ends = (last.join(answers, (F.col("last_conv") == F.col("for_conv")) & (F.col("last_turn") == F.col("for_turn")), "left")
            .select("last_conv", "last_turn", F.coalesce("answer", F.lit("")).alias("answer")))
    before = (chosen.join(ends.select("last_conv", "last_turn"), F.col("pair_id").eqNullSafe(F.col("last_conv")), "left")
              .where(F.col("last_turn").isNull() | F.col("turn").isNull() | (F.col("turn") < F.col("last_turn")))
              .select("pair_id", "turn", "role", "text"))
    answered = ends.select(F.col("last_conv").alias("pair_id"), F.col("last_turn").alias("turn"), F.lit("assistant").alias("role"),
                           F.col("answer").alias("text"))
    return chosen, before.unionByName(answered)


#: The same rows in DuckDB's SQL.
CONVERSATION_SQL = """
WITH chosen AS (SELECT conv_id AS pair_id, turn, role, text FROM conversations),
spoken AS (SELECT conv_id, turn, text FROM conversations WHERE role = 'assistant'),
last_said AS (SELECT conv_id, max(turn) AS turn FROM spoken GROUP BY conv_id HAVING max(turn) IS NOT NULL),
answers AS (SELECT conv_id - 1 AS conv_id, turn, min(text) AS text FROM spoken GROUP BY ALL),
rejected AS (
  SELECT c.* FROM chosen c LEFT JOIN last_said l ON c.pair_id = l.conv_id
  WHERE l.turn IS NULL OR c.turn IS NULL OR c.turn < l.turn
  UNION ALL
  SELECT l.conv_id, l.turn, 'assistant', coalesce(a.text, '') FROM last_said l LEFT JOIN answers a USING (conv_id, turn)),
a AS (SELECT *, row_number() OVER (PARTITION BY pair_id, turn ORDER BY role NULLS FIRST, text NULLS FIRST) - 1 AS ord FROM chosen),
b AS (SELECT *, row_number() OVER (PARTITION BY pair_id, turn ORDER BY role NULLS FIRST, text NULLS FIRST) - 1 AS ord FROM rejected),
sides AS (
  SELECT coalesce(a.pair_id, b.pair_id) AS pair_id, coalesce(a.turn, b.turn) AS turn, coalesce(a.ord, b.ord) AS ord,
         a.ord IS NOT NULL AS in_a, b.ord IS NOT NULL AS in_b, a.role AS a_role, a.text AS a_text, b.role AS b_role, b.text AS b_text,
         a.ord IS NOT NULL AND b.ord IS NOT NULL AND a.role IS NOT DISTINCT FROM b.role AND a.text IS NOT DISTINCT FROM b.text AS alike
  FROM a FULL JOIN b ON a.pair_id = b.pair_id AND a.turn = b.turn AND a.ord = b.ord),
ranked AS (SELECT *, bool_and(alike) OVER (PARTITION BY pair_id ORDER BY turn, ord) AS shared FROM sides),
parts AS (
  SELECT pair_id, CASE WHEN shared THEN 'prompt' ELSE 'chosen' END AS part, turn, ord, a_role AS role, a_text AS text FROM ranked WHERE in_a
  UNION ALL
  SELECT pair_id, 'rejected', turn, ord, b_role, b_text FROM ranked WHERE in_b AND NOT shared)
SELECT pair_id, part, turn, ord, role,
       '<|im_start|>' || coalesce(role, '') || chr(10) || replace(coalesce(text, ''), '<|im_', '<| im_') || '<|im_end|>' || chr(10) AS rendered,
       coalesce(part <> 'prompt' AND role = 'assistant', false) AS loss
FROM parts
"""
