"""Preference formatting: one prompt and two masked completions per pair.

Turns of the chosen and the rejected conversation are put in order; their
longest common prefix (equal role and text, turn by turn) is rendered once as
the prompt, the rest of each side is its completion. A completion's mask lists
the places [start, end) in code points of what assistants say, end mark
included: only there a loss is taken.

Built-in functions only; one shuffle by pair, whose group is the pair's own
two conversations, the size of its output row.

Null texts render as empty, a null role as `unknown`; both compare as equal to
null alone. Turns are ordered by number, role and text, nulls first, so repeated
numbers have a defined order. A pair of which one side is missing has prompt
empty, that side's completion and mask null, and paired false. Rows without a
pair id belong to no pair and are left out, as are extra columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

END = "<|end|>\n"


def _render(t):
    return F.concat(F.lit("<|"), F.coalesce(t["role"], F.lit("unknown")), F.lit("|>\n"),
                    F.coalesce(t["text"], F.lit("")), F.lit(END))


def _text(turns):
    return F.array_join(F.transform(turns, _render), "")


def _mask(turns):
    """'start:end' of each assistant turn's text and end mark, comma-joined."""
    def add(acc, t):
        end = acc["at"] + F.length(_render(t)).cast("long")
        start = end - F.length(F.coalesce(t["text"], F.lit(""))) - len(END)
        span = F.concat(start.cast("string"), F.lit(":"), end.cast("string"))
        spans = F.when(t["role"] == "assistant", F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"])
        return F.struct(end.alias("at"), spans.alias("spans"))

    zero = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("spans"))
    return F.aggregate(turns, zero, add, lambda acc: F.array_join(acc["spans"], ","))


def format_preferences(turns: DataFrame, pair_col: str = "pair_id", chosen_col: str = "is_chosen",
                       turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per pair: pair_id, paired, n_prefix_turns, prompt, chosen,
    chosen_mask, rejected, rejected_mask. ``turns`` has a row per turn."""
    t = turns.select(turns[pair_col].alias("pair_id"), turns[chosen_col].alias("side"),
                     F.struct(turns[turn_col].alias("turn"), turns[role_col].alias("role"),
                              turns[text_col].alias("text")).alias("t")).where("pair_id is not null")
    pairs = t.groupBy("pair_id").agg(
        F.sort_array(F.collect_list(F.when(F.col("side"), F.col("t")))).alias("c"),
        F.sort_array(F.collect_list(F.when(~F.col("side"), F.col("t")))).alias("r"))
    same = F.zip_with("c", "r", lambda a, b: a.isNotNull() & b.isNotNull() & a["role"].eqNullSafe(b["role"])
                      & a["text"].eqNullSafe(b["text"]))
    first = F.array_position(same, False)
    pairs = pairs.withColumn("n", F.when(first > 0, first - 1).otherwise(F.size("c").cast("long")))
    cut = lambda side: F.slice(side, F.col("n").cast("int") + 1, F.greatest(F.size(side), F.lit(1)))
    pairs = (pairs.withColumn("paired", (F.size("c") > 0) & (F.size("r") > 0))
             .withColumn("prefix", F.slice("c", F.lit(1), F.col("n").cast("int")))
             .withColumn("cc", F.when(F.size("c") > 0, cut("c"))).withColumn("rc", F.when(F.size("r") > 0, cut("r"))))
    return pairs.select("pair_id", "paired", F.col("n").alias("n_prefix_turns"), _text(F.col("prefix")).alias("prompt"),
                        _text(F.col("cc")).alias("chosen"), _mask(F.col("cc")).alias("chosen_mask"),
                        _text(F.col("rc")).alias("rejected"), _mask(F.col("rc")).alias("rejected_mask"))


#: The same over the conversations table: chosen as it is, rejected with the last assistant
#: turn replaced by that of the conversation whose id differs in the last bit.
ORACLE = """
WITH la AS (
  SELECT conv_id, turn AS at, text FROM conversations WHERE conv_id IS NOT NULL AND role = 'assistant'
  QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC NULLS LAST, text DESC NULLS LAST) = 1),
src AS (
  SELECT conv_id AS pair_id, true AS side, turn, role, text FROM conversations WHERE conv_id IS NOT NULL
  UNION ALL
  SELECT c.conv_id, false, c.turn, c.role,
         CASE WHEN c.role = 'assistant' AND c.turn = la.at AND o.conv_id IS NOT NULL THEN o.text ELSE c.text END
  FROM conversations c LEFT JOIN la ON la.conv_id = c.conv_id LEFT JOIN la o ON o.conv_id = xor(c.conv_id, 1)
  WHERE c.conv_id IS NOT NULL),
t AS (
  SELECT pair_id, side, role, text,
         '<|' || coalesce(role, 'unknown') || '|>' || chr(10) || coalesce(text, '') || '<|end|>' || chr(10) AS shown,
         row_number() OVER (PARTITION BY pair_id, side ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS pos
  FROM src),
matched AS (
  SELECT coalesce(c.pair_id, r.pair_id) AS pair_id, coalesce(c.pos, r.pos) AS pos,
         c.pos IS NOT NULL AND r.pos IS NOT NULL AND c.role IS NOT DISTINCT FROM r.role
           AND c.text IS NOT DISTINCT FROM r.text AS same,
         c.pos IS NOT NULL AS has_c, r.pos IS NOT NULL AS has_r
  FROM (SELECT * FROM t WHERE side) c FULL JOIN (SELECT * FROM t WHERE NOT side) r
    ON c.pair_id = r.pair_id AND c.pos = r.pos),
heads AS (
  SELECT pair_id, coalesce(min(pos) FILTER (WHERE NOT same) - 1, max(pos)) AS n, bool_or(has_c) AND bool_or(has_r) AS paired
  FROM matched GROUP BY pair_id),
rest AS (
  SELECT t.*, n, sum(CASE WHEN pos > n THEN length(shown) ELSE 0 END)
           OVER (PARTITION BY t.pair_id, side ORDER BY pos) AS stop
  FROM t JOIN heads USING (pair_id)),
sides AS (
  SELECT pair_id, side,
         coalesce(string_agg(shown, '' ORDER BY pos) FILTER (WHERE pos <= n), '') AS prompt,
         coalesce(string_agg(shown, '' ORDER BY pos) FILTER (WHERE pos > n), '') AS body,
         coalesce(string_agg((stop - length(coalesce(text, '')) - 8) || ':' || stop, ',' ORDER BY pos)
                  FILTER (WHERE pos > n AND role = 'assistant'), '') AS mask
  FROM rest GROUP BY pair_id, side)
SELECT h.pair_id, h.paired, h.n AS n_prefix_turns, CASE WHEN h.paired THEN c.prompt ELSE '' END AS prompt,
       c.body AS chosen, c.mask AS chosen_mask, r.body AS rejected, r.mask AS rejected_mask
FROM heads h LEFT JOIN sides c ON c.pair_id = h.pair_id AND c.side
             LEFT JOIN sides r ON r.pair_id = h.pair_id AND NOT r.side
"""
