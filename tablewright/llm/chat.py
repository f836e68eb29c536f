"""Chat formatting: collapse cumulative snapshots, then render the maximal conversations.

A chat log often stores a conversation again after every turn, so most logged
conversations are prefixes of longer ones.  Each turn is hashed together with
its rank, and a running XOR over the conversation gives a hash of every turn
prefix.  Conversations with equal full hashes are copies (the smallest
``conv_id`` stays); an anti-join against the strict prefixes of all
conversations leaves the maximal ones, which alone are rendered.

A conversation becomes one row, so the turns of one fit into a task.  Turns
without ``conv_id``, any number of them, belong to no conversation and are
dealt by their contents, each a conversation of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed values of the rendered layout.
TURN_OPEN = "<|im_start|>"
TURN_CLOSE = "<|im_end|>"


def numbered_turns(turns: DataFrame) -> DataFrame:
    """Turns of each conversation, repeated rows dropped, ranked, with prefix hashes.

    Null roles read ``unknown`` and null texts are empty; ties of ``turn`` are
    ordered by role, then text; null ``turn`` sorts first.  A row without
    ``conv_id`` is a conversation of one turn.
    """
    all_said = turns.select("conv_id", "turn", F.coalesce("role", F.lit("unknown")).alias("role"),
                            F.coalesce("text", F.lit("")).alias("text"))
    said = all_said.where(F.col("conv_id").isNotNull())
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")

    def again(c: str) -> Column:
        return F.lag(c).over(order).eqNullSafe(F.col(c))

    said = (said.withColumn("_again", (F.row_number().over(order) > 1) & again("turn") & again("role") & again("text"))
            .where(~F.col("_again")).drop("_again"))
    running = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    said = said.withColumn("k", F.row_number().over(order))
    for name, seed in (("p1", 1), ("p2", 2)):
        said = said.withColumn(name, F.bit_xor(F.xxhash64(F.lit(seed), "k", "role", "text")).over(running))
    said = said.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("conv_id")))
    lone = all_said.where(F.col("conv_id").isNull()).distinct().withColumn("k", F.lit(1))
    for name, seed in (("p1", 1), ("p2", 2)):
        lone = lone.withColumn(name, F.xxhash64(F.lit(seed), "k", "role", "text"))
    return said.unionByName(lone.withColumn("n", F.lit(1).cast("long")))


def maximal_conversations(numbered: DataFrame) -> DataFrame:
    """``conv_id, n_turns, n_copies, p1, p2`` of conversations that are no strict prefix of another."""
    key = ["k", "p1", "p2"]
    prefixes = numbered.where("k < n").select(*key).distinct()
    whole = numbered.where("k = n").groupBy(*key).agg(F.min("conv_id").alias("conv_id"),
                                                      F.count(F.lit(1)).alias("n_copies"))
    return whole.join(prefixes, key, "left_anti").select(
        "conv_id", F.col("k").cast("long").alias("n_turns"), "n_copies", "p1", "p2")


def _inert(text: Column) -> Column:
    """Text in which the layout's markers can no longer be read as markers."""
    return F.replace(text, F.lit("<|"), F.lit("< |"))


def format_chats(turns: DataFrame, trained_role: str = "assistant") -> DataFrame:
    """One rendered row per maximal conversation of ``turns(conv_id, turn, role, text)``.

    Returns ``conv_id, n_turns, n_copies, text, trained_chars``: ``n_copies``
    counts the equal conversations collapsed into the row and
    ``trained_chars`` the code points of turns by ``trained_role``.  Of equal
    conversations the one with the smallest ``conv_id`` is returned; ``conv_id``
    is null where none of them has one.  Extra columns are ignored; an empty
    table gives no rows.
    """
    numbered = numbered_turns(turns)
    kept = maximal_conversations(numbered)
    segment = F.concat(F.lit(TURN_OPEN), _inert(F.col("role")), F.lit("\n"), _inert(F.col("text")), F.lit(TURN_CLOSE + "\n"))
    said = numbered.select("conv_id", "k", "p1", "p2", segment.alias("segment"),
                           F.when(F.col("role") == trained_role, F.length(_inert(F.col("text")))).otherwise(0).alias("trained"))
    lone = (said.where(F.col("conv_id").isNull()).dropDuplicates(["p1", "p2"]).drop("conv_id")
            .join(kept.where(F.col("conv_id").isNull()), ["p1", "p2"])
            .select("conv_id", "n_turns", "n_copies", F.col("segment").alias("text"), F.col("trained").cast("long").alias("trained_chars")))
    return (said.drop("p1", "p2").join(kept.drop("p1", "p2"), "conv_id").groupBy("conv_id", "n_turns", "n_copies")
            .agg(F.sort_array(F.collect_list(F.struct("k", "segment"))).alias("parts"),
                 F.sum("trained").cast("long").alias("trained_chars"))
            .select("conv_id", "n_turns", "n_copies", F.array_join("parts.segment", "").alias("text"), "trained_chars")
            .unionByName(lone))


ORACLE = r"""
WITH t AS (
  SELECT DISTINCT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text FROM conversations
), c AS (
  SELECT conv_id, list(role || chr(31) || text ORDER BY turn NULLS FIRST, role, text) AS said,
         string_agg('<|im_start|>' || replace(role, '<|', '< |') || chr(10) || replace(text, '<|', '< |')
                    || '<|im_end|>' || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS text,
         sum(CASE WHEN role = 'assistant' THEN length(replace(text, '<|', '< |')) ELSE 0 END) AS trained_chars
  FROM (SELECT *, CASE WHEN conv_id IS NULL THEN row_number() OVER () END AS own FROM t) GROUP BY conv_id, own
), prefixes AS (
  SELECT DISTINCT list_slice(said, 1, n) AS said
  FROM (SELECT said, unnest(range(1, len(said))) AS n FROM c)
), whole AS (
  SELECT said, min(conv_id) AS conv_id, count(*) AS n_copies FROM c GROUP BY said
)
SELECT w.conv_id, CAST(len(w.said) AS BIGINT) AS n_turns, w.n_copies, c.text, CAST(c.trained_chars AS BIGINT) AS trained_chars
FROM whole w JOIN (SELECT DISTINCT conv_id, said, text, trained_chars FROM c) c
  ON c.conv_id IS NOT DISTINCT FROM w.conv_id AND c.said = w.said
WHERE NOT EXISTS (SELECT 1 FROM prefixes p WHERE p.said = w.said)
"""
