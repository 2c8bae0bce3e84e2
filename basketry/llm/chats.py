"""Chat formatting: logged conversations that are prefixes of longer ones collapse into those, then are rendered.

Every turn gets a hash of its place, role and text; the rolling hash of a prefix is the xor of its turns' hashes,
kept twice with independent hashes (128 bits). A conversation is a snapshot of a longer one if its whole hash is
the rolling hash of as many first turns there. An anti-join against those prefixes leaves the maximal
conversations; of equal ones the smallest conv_id stays. All turns are sorted by range, repeated ones too, so a long
conversation is cut into blocks, the ranges, whatever its turn numbers are. As xor has no order, blocks are numbered
and summed up by themselves, and no task needs a whole conversation.

Turns are ordered by turn, then role and text; gaps in the numbering don't matter. Null role or text is a value
of its own; turns without conv_id are dropped, as they belong to no conversation, and those without a turn number
come first. Repeated turns count each; a tie between equal rows is broken by their place in the input, which must be
a table or a stage, read alike each time. An empty table gives no rows. Other columns may have any name.

Rendering: one line per turn, <|role|> and the text, ended by <|end|>; null role or text renders as empty. A
conversation is returned in parts of PART turns, so the text of one row is bounded by what PART turns hold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from basketry.functions.lineage import staged
from basketry.llm.common import read_table

PART = 1024
# monotonically_increasing_id keeps the row within its partition in the low 33 bits.
_ROW_BITS = 33


def sorted_turns(turns: DataFrame, parts: int | None = None) -> DataFrame:
    """(conv_id, role, text, block, slot): turns dealt out by range and sorted, block being the range, written once."""
    rows = turns.where("conv_id is not null").select(
        "conv_id", "turn", "role", "text", F.monotonically_increasing_id().alias("tie")
    )
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "text", "tie")]
    dealt = rows.repartitionByRange(parts, *order) if parts else rows.repartitionByRange(*order)
    slot = F.monotonically_increasing_id()
    written = dealt.sortWithinPartitions(*order).select("conv_id", "role", "text", slot.alias("slot"))
    return staged(written, "turns").withColumn("block", F.shiftright("slot", _ROW_BITS))


def numbered_turns(turns: DataFrame, parts: int | None = None) -> DataFrame:
    """(conv_id, role, text, place, n_turns, a, b): turns numbered from 1 among the conversation's n_turns, with the
    rolling hashes of the prefixes."""
    rows = sorted_turns(turns, parts)
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sizes = rows.groupBy("conv_id", "block").agg(F.count(F.lit(1)).alias("n"), F.min("slot").alias("first"))
    # A row per conversation and block: written, so that the planner sees whether it may be broadcast.
    starts = staged(sizes.select(
        "conv_id", "block", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first") + 1).alias("shift"),
        F.sum("n").over(Window.partitionBy("conv_id")).alias("n_turns"),
    ), "turn-starts")
    rows = rows.join(starts, ["conv_id", "block"]).withColumn("place", F.col("slot") + F.col("shift"))
    # Nulls are told from empty strings by flags.
    values = [F.col("place"), F.col("role").isNull(), F.col("role"), F.col("text").isNull(), F.col("text")]
    rows = rows.select("conv_id", "block", "role", "text", "place", "n_turns",
                       F.xxhash64(*values).alias("x"), F.xxhash64(F.lit("second"), *values).alias("y"))
    sums = rows.groupBy("conv_id", "block").agg(F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y"))
    earlier = staged(sums.select("conv_id", "block", *[
        F.coalesce(F.bit_xor(c).over(before), F.lit(0)).alias(f"{c}0") for c in ("x", "y")
    ]), "turn-hashes")
    running = Window.partitionBy("conv_id", "block").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    return rows.join(earlier, ["conv_id", "block"]).select(
        "conv_id", "role", "text", "place", "n_turns",
        *[F.bit_xor(c).over(running).bitwiseXOR(F.col(f"{c}0")).alias(h) for c, h in (("x", "a"), ("y", "b"))],
    )


def maximal_conversations(prefixes: DataFrame) -> DataFrame:
    """(conv_id, n_turns) of the conversations that no longer one begins with, one of equal ones, from
    (conv_id, place, n_turns, a, b), a row for every prefix."""
    whole = F.col("place") == F.col("n_turns")
    wholes = prefixes.where(whole).groupBy("place", "a", "b").agg(F.min("conv_id").alias("conv_id"))
    longer = prefixes.where(~whole).select("place", "a", "b").distinct()
    return wholes.join(longer, ["place", "a", "b"], "left_anti").select("conv_id", F.col("place").alias("n_turns"))


def render(turns: DataFrame, part: int = PART) -> DataFrame:
    """(conv_id, n_turns, part, text) of numbered turns (conv_id, n_turns, place, role, text)."""
    empty = F.lit("")
    line = F.concat(
        F.lit("<|"), F.coalesce("role", empty), F.lit("|>\n"), F.coalesce("text", empty), F.lit("<|end|>\n")
    )
    pieces = turns.select(
        "conv_id", "n_turns", F.floor((F.col("place") - 1) / part).alias("part"),
        F.struct("place", line.alias("line")).alias("p"),
    )
    joined = F.array_join(F.transform(F.array_sort(F.collect_list("p")), lambda p: p["line"]), "")
    return pieces.groupBy("conv_id", "n_turns", "part").agg(joined.alias("text"))


def format_chats(turns: DataFrame, parts: int | None = None, part: int = PART) -> DataFrame:
    """(conv_id, n_turns, part, text) of the maximal conversations in turns (conv_id, turn, role, text)."""
    numbered = staged(numbered_turns(turns, parts), "prefixes")
    kept = staged(maximal_conversations(numbered.select("conv_id", "place", "n_turns", "a", "b")), "maximal")
    return render(numbered.join(kept.select("conv_id"), "conv_id"), part)


def op10_chats(spark: SparkSession, folder: str) -> DataFrame:
    return format_chats(read_table(spark, folder, "conversations"))


QUERIES = {"op10_chats": op10_chats}
SQL = {
    "op10_chats": """
WITH numbered AS (
    SELECT conv_id, role, text,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS place
    FROM conversations WHERE conv_id IS NOT NULL
), chats AS (
    SELECT conv_id, count(*) AS n_turns,
           list({'role': role, 'text': text} ORDER BY place) AS turns,
           string_agg('<|' || coalesce(role, '') || '|>' || chr(10) || coalesce(text, '') || '<|end|>' || chr(10), ''
                      ORDER BY place) AS text
    FROM numbered GROUP BY conv_id
)
SELECT c.conv_id, c.n_turns, CAST(0 AS BIGINT) AS part, c.text
FROM chats c
WHERE NOT EXISTS (
    SELECT 1 FROM chats d
    WHERE d.turns[1] IS NOT DISTINCT FROM c.turns[1]
      AND ((d.n_turns > c.n_turns AND d.turns[1:c.n_turns] = c.turns)
           OR (d.turns = c.turns AND d.conv_id < c.conv_id))
)
""",
}
