"""Mixing sources to target weights over fixed-length blocks.

The words of a source, documents in ascending id order, form one stream that
is cut into blocks of ``block_words`` words.  The mix is a list of output
shards of ``shard_slots`` slots, a block each.  Every shard draws how many of
its slots each source gets: multinomial counts by the sources' shares of the
mix, conditioned on each source's total over all shards, so targets are met
exactly.  The slots of a shard stand in a random order.  Slot ``j`` of a
source takes block ``permutation(j mod blocks)`` of a keyed permutation (a new
one for every pass over the source), and blocks join slots by index.  Nothing
is drawn twice in a pass, so a document is taken at most once per pass.

All draws are functions of the seed, the source and the index: reruns agree.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewright.llm.common import parquet_table, words_of
from tablewright.llm.vectors import U64, mix

WEIGHTS = (3, 1, 2)      # by rank of the source's name, repeating
SHARE = 1.5              # words of the mix, as a share of all words
MOST = 2.0               # passes over a source, at most
BLOCK_WORDS = 64         # words of a block; a source has 256 blocks at least, so small sources have shorter ones
LEAST_BLOCKS = 256
SHARD_SLOTS = 4096       # slots of one output shard
MOST_SOURCES = 100_000   # sources of a mix; their numbers of slots go to every task
CHUNK_DOCS = 5_000       # documents of one numbering chunk, about
_ROUNDS = 6


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """``source, source_size, target``: weights share out ``share`` of all words; a target stops at
    ``most`` times its source, and what is left over goes to the others by weight.

    The stopped sources are those with the lowest limit per weight, so one
    ordered pass finds them: source by source, the words left divided by the
    weights left is the level, and a source stops when its limit is below it.
    """
    total = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    # utf-8 order is code point order; one row per source from here on
    rank = Window.partitionBy(F.lit(0)).orderBy(F.col("source").isNull(), "source")
    w = F.array(*[F.lit(float(x)) for x in weights])
    s = total.withColumn("_w", F.get(w, (F.row_number().over(rank) - 1) % len(weights)))
    s = s.withColumn("_limit", F.col("source_size") * float(most))
    every = Window.partitionBy(F.lit(0))
    low = every.orderBy(F.col("_limit") / F.col("_w"), F.col("source").isNull(), "source")
    before = low.rowsBetween(Window.unboundedPreceding, -1)
    words = F.sum("source_size").over(every) * float(share)
    left = words - F.coalesce(F.sum("_limit").over(before), F.lit(0.0))
    weight = F.sum("_w").over(every) - F.coalesce(F.sum("_w").over(before), F.lit(0.0))
    s = s.withColumn("_level", left / weight)
    s = s.withColumn("_place", F.row_number().over(low))
    s = s.withColumn("_stops", F.col("_limit") <= F.col("_level") * F.col("_w"))
    s = s.withColumn("_final", F.min(F.when(~F.col("_stops"), F.struct("_place", "_level"))).over(every)["_level"])
    return s.select("source", "source_size",
                    F.when(F.col("_stops"), F.col("_limit")).otherwise(F.col("_final") * F.col("_w")).alias("target"))


def _numbered(sizes: DataFrame, n_docs: int) -> DataFrame:
    """First word of every document in its source's stream.

    The stream runs chunk by chunk, in a chunk by id; chunks are dealt by a
    hash of the id, so a source with most of the documents is numbered by many
    tasks, and only one row per source and chunk meets in a window.
    """
    chunks = max(1, math.ceil(n_docs / CHUNK_DOCS))
    dealt = sizes.withColumn("_chunk", F.pmod(F.xxhash64("id", "th"), F.lit(chunks)))
    order = Window.partitionBy("source", "_chunk").orderBy("id", "th")
    inner = F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("size")
    dealt = dealt.withColumn("_inner", inner)
    starts = dealt.groupBy("source", "_chunk").agg(F.sum("size").alias("_words"))
    along = Window.partitionBy("source").orderBy("_chunk")
    starts = starts.select(F.col("source").alias("_s"), F.col("_chunk").alias("_c"), (
        F.sum("_words").over(along.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("_words")).alias("_start"))
    joined = dealt.join(starts, F.col("source").eqNullSafe(F.col("_s")) & (F.col("_chunk") == F.col("_c")))
    return joined.select("source", "id", "th", "size", (F.col("_start") + F.col("_inner")).alias("start"))


# ------------------------------------------------------------- draws
def permute(index: np.ndarray, n: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Keyed permutations of ``range(n)``, element-wise: Feistel rounds on the next even number of
    bits, repeated for values that fall outside the range."""
    half = np.maximum(1, (np.ceil(np.log2(np.maximum(n, 2))).astype(np.int64) + 1) // 2).astype(U64)
    mask = (U64(1) << half) - U64(1)
    out = index.astype(U64).copy()
    todo = np.ones(len(out), bool)
    while todo.any():
        h, m, k = half[todo], mask[todo], key[todo]
        left, right = out[todo] >> h, out[todo] & m
        for r in range(_ROUNDS):
            left, right = right, left ^ (mix(right + k + U64((r + 1) * 0x9E3779B97F4A7C15 & (2**64 - 1))) & m)
        out[todo] = (left << h) | right
        todo[todo] = out[todo] >= n[todo].astype(U64)
    return out.astype(np.int64)


def source_key(name: str | None, seed: int) -> int:
    """64-bit key of a source for its permutations and counts."""
    raw = b"" if name is None else b"s" + name.encode()
    h = np.array([seed & (2**64 - 1)], U64)
    for i in range(0, len(raw), 8):
        h = mix(h + np.frombuffer(raw[i:i + 8].ljust(8, b"\0"), U64)) + U64(len(raw))
    return int(h[0])


def shard_counts(slots: int, shards: int, first: int, last: int, key: int) -> np.ndarray:
    """Slot counts of shards ``first..last-1`` and, before them, all slots of earlier shards.

    One multinomial draw over equal shards, made by halving: each half's share
    is a binomial draw seeded by its place, so any range of shards can be
    drawn alone.
    """
    out = np.zeros(last - first + 1, np.int64)  # out[0]: slots before `first`

    def halve(a: int, b: int, n: int) -> None:
        if a >= last:
            return
        if b <= first:
            out[0] += n
        elif b - a == 1:
            out[1 + a - first] = n
        else:
            mid = (a + b) // 2
            rng = np.random.default_rng([key, a, b])
            low = int(rng.binomial(n, (mid - a) / (b - a))) if n else 0
            halve(a, mid, low)
            halve(mid, b, n - low)

    halve(0, shards, slots)
    return out


def _without_replacement(rng: np.random.Generator, good: int, bad: int, drawn: int) -> int:
    """How many of ``drawn`` items of ``good + bad`` are good; from a billion items on by the normal law it tends to."""
    if good + bad < 10**9:
        return int(rng.hypergeometric(good, bad, drawn)) if drawn else 0
    total, mean = good + bad, drawn * (good / (good + bad))
    spread = math.sqrt(mean * (bad / total) * ((total - drawn) / (total - 1)))
    return min(max(round(rng.normal(mean, spread)), drawn - bad, 0), good, drawn)


def draw_counts(slots: np.ndarray, shard_slots: int, first: int, last: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Slots of each source before shard ``first``, and in the shards ``first..last-1`` (a row each).

    The sources' counts of all shards are one draw with the totals ``slots``,
    made by halving the shards: the first half's counts are drawn without
    replacement from those of both, seeded by the place, so any range of shards
    can be drawn alone.  All shards but the last have ``shard_slots`` slots.
    """
    shards = -(-int(slots.sum()) // shard_slots)
    before, counts = np.zeros(len(slots), np.int64), np.zeros((last - first, len(slots)), np.int64)

    def halve(a: int, b: int, n: np.ndarray) -> None:
        nonlocal before
        if a >= last:
            return
        if b <= first:
            before = before + n
        elif b - a == 1:
            counts[a - first] = n
        else:
            mid = (a + b) // 2
            rng = np.random.default_rng([seed & (2**64 - 1), a, b])
            left, total, low = (mid - a) * shard_slots, int(n.sum()), np.zeros(len(n), np.int64)
            for s, own in enumerate(n.tolist()):
                total -= own
                low[s] = _without_replacement(rng, own, total, left)
                left -= int(low[s])
            halve(a, mid, low)
            halve(mid, b, n - low)

    if shards:
        halve(0, shards, slots.astype(np.int64))
    return before, counts


def _draw_slots(sources: list[tuple[str | None, int, int, int, int]], shard_slots: int, seed: int):
    """One row per slot of the shards given: shard, slot, source, pass, block index and the words taken of it."""
    slots = np.array([s[1] for s in sources], np.int64)
    keys = np.array([source_key(s[0], seed) for s in sources], U64)
    names = np.array([s[0] for s in sources], object)
    numbers = [np.array([s[k] for s in sources], np.int64) for k in (2, 1, 3, 4)]  # blocks, slots, words, words of a block

    def of_shard(shard: int, before: np.ndarray, counts: np.ndarray) -> pd.DataFrame:
        held = np.flatnonzero(counts)
        n = counts[held]
        which = np.repeat(held, n)
        # the n-th slots of each source, counted through all shards
        j = before[which] + np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
        blocks, total, words, block = (col[which] for col in numbers)
        passes = j // blocks
        key = mix(keys[which] + (passes + 1).astype(U64) * U64(0xD1342543DE82EF95))
        order = U64(source_key(None, seed + 1)) + mix(np.array([shard], U64))[0]
        return pd.DataFrame({
            "shard": np.int64(shard), "slot": permute(np.arange(len(j)), np.full(len(j), len(j), np.int64), np.full(len(j), order, U64)),
            "source": names[which], "pass": passes, "block": permute(j % blocks, blocks, key),
            # the source's last slot is cut to the words left of the target
            "words": np.where(j == total - 1, words - (total - 1) * block, block)})

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            shards = np.sort(frame["shard"].to_numpy())
            for together in np.split(shards, np.flatnonzero(np.diff(shards) > 1) + 1):  # one draw for neighbours
                for a in range(0, len(together), 64):
                    some = together[a:a + 64]
                    before, counts = draw_counts(slots, shard_slots, int(some[0]), int(some[-1]) + 1, seed)
                    for shard, row in zip(some.tolist(), counts):
                        yield of_shard(shard, before, row)
                        before = before + row
    return run


# ------------------------------------------------------------- the mix
def _same(a: str, b: str) -> Column:
    return F.col(a).eqNullSafe(F.col(b))


def _taken_ranges(sizes: DataFrame, targets: DataFrame, most: float, block_words: int, shard_slots: int, seed: int) -> DataFrame:
    """``shard, slot, id, th, source, pass, lo, hi``: word ranges of the documents that the slots take."""
    block = F.greatest(F.lit(1), F.least(F.lit(block_words), F.floor(F.col("source_size") / LEAST_BLOCKS).cast("int")))
    cut = (targets.where("source_size > 0 AND target > 0").withColumn("block_words", block.cast("long"))
           .withColumn("blocks", F.ceil(F.col("source_size") / F.col("block_words")))
           .withColumn("words", F.round("target").cast("long"))
           .withColumn("slots", F.least(F.ceil(F.col("words") / F.col("block_words")),
                                        F.floor(F.lit(float(most)) * F.col("blocks")).cast("long"))))
    spark = sizes.sparkSession
    sources = [tuple(r) for r in cut.where("slots > 0").select("source", "slots", "blocks", "words", "block_words").orderBy("source").limit(
        MOST_SOURCES + 1).collect()]
    if len(sources) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources; group them before mixing")
    shards = -(-sum(r[1] for r in sources) // shard_slots)
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    plan = spark.range(0, shards, 1, max(1, min(shards, width * 4))).withColumnRenamed("id", "shard")
    # stored, so that the join below knows how many there are and doesn't take them for a small side
    slots = parquet_table(plan.mapInPandas(_draw_slots(sources, shard_slots, seed),
                                           "shard long, slot long, source string, pass long, block long, words long"), "mix-slots")
    numbered = _numbered(sizes, sizes.count()).where("size > 0")
    numbered = numbered.join(cut.select(F.col("source").alias("_c"), "block_words"), _same("source", "_c"))
    b, start, end = F.col("block_words"), F.col("start"), F.col("start") + F.col("size")
    pieces = (numbered.select(F.col("source").alias("_s"), "id", "th", "start", "size", "block_words",
                              F.explode(F.sequence(F.floor(start / b), F.floor((end - 1) / b))).alias("_b")))
    joined = pieces.join(slots, _same("_s", "source") & (F.col("_b") == F.col("block")))
    lo, hi = F.greatest(start, F.col("_b") * b), F.least(end, F.col("_b") * b + F.col("words"))
    return (joined.select("shard", "slot", "id", "th", F.col("_s").alias("source"), "pass", (lo - start).alias("lo"), (hi - start).alias("hi"))
            .where("lo < hi"))


def _mix(docs: DataFrame, id_col: str, text_col: str, source_col: str, weights: tuple[int, ...], share: float, most: float,
         block_words: int, shard_slots: int, seed: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    text = F.col(f"`{text_col}`")
    sizes = parquet_table(docs.select(F.col(f"`{id_col}`").alias("id"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("th"),
                                      F.col(f"`{source_col}`").alias("source"), F.size(words_of(text)).cast("long").alias("size"))
                          .distinct(), "mix-sizes")
    targets = parquet_table(source_targets(sizes, weights, share, most), "mix-targets")
    return sizes, targets, _taken_ranges(sizes, targets, most, block_words, shard_slots, seed)


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST,
                block_words: int = BLOCK_WORDS, shard_slots: int = SHARD_SLOTS, seed: int = 17) -> DataFrame:
    """``id, th, source, size, source_size, target, taken``: words that the slots of all shards take of every document.

    ``th`` is the text's hash: rows that repeat an id, its text and source are
    one document here.  A null text has no words, a null source is a source of
    its own (ranked last), null ids sort first.  A source without words has
    target 0; an empty table gives no rows; other columns are not read.
    """
    sizes, targets, ranges = _mix(docs, id_col, text_col, source_col, weights, share, most, block_words, shard_slots, seed)
    taken = (ranges.groupBy("id", "th", "source").agg(F.sum(F.col("hi") - F.col("lo")).alias("taken"))
             .withColumnsRenamed({"id": "_i", "th": "_t", "source": "_s"}))
    rows = sizes.join(taken, _same("id", "_i") & (F.col("th") == F.col("_t")) & _same("source", "_s"), "left").drop("_s")
    return rows.join(targets.withColumnRenamed("source", "_s"), _same("source", "_s")).select(
        "id", "th", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def _worded(docs: DataFrame, ranges: DataFrame, id_col: str, text_col: str, source_col: str, by: list[str]) -> tuple[list[str], DataFrame]:
    """Documents with the ranges taken of them, grouped by ``by``: the columns of ``docs`` in a struct, the words of the text."""
    names = docs.columns
    kept = (ranges.groupBy("id", "th", "source", *by)
            .agg(F.sort_array(F.collect_list(F.struct("lo", "hi"))).alias("_ranges"), F.sum(F.col("hi") - F.col("lo")).alias("_words"))
            .withColumnsRenamed({"id": "_i", "th": "_t", "source": "_s"}))
    # all columns in one struct, so that their names can't clash with those used here
    folded = docs.dropDuplicates([id_col, text_col, source_col]).select(
        F.struct(*[F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(names)]).alias("_row"))
    at = {c: F.col("_row").getField(f"c{k}") for k, c in enumerate(names)}
    folded = folded.select("_row", at[id_col].alias("_id"), F.xxhash64(F.coalesce(at[text_col], F.lit(""))).alias("_th"), at[source_col].alias("_source"))
    joined = folded.join(kept, _same("_id", "_i") & (F.col("_th") == F.col("_t")) & _same("_source", "_s"))
    return names, joined.select("_row", *by, "_ranges", "_words", F.explode(F.array(words_of(at[text_col]))).alias("_all"))


def _some_words() -> Column:
    return F.array_join(F.flatten(F.transform("_ranges", lambda r: F.slice("_all", (r["lo"] + 1).cast("int"), (r["hi"] - r["lo"]).cast("int")))), " ")


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                    weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST,
                    block_words: int = BLOCK_WORDS, shard_slots: int = SHARD_SLOTS, seed: int = 17) -> DataFrame:
    """The mix by document: a row of ``docs`` for each pass that takes words of it, with the words taken as its text.

    A document taken whole keeps its text as it is; otherwise its taken words
    are joined by one space.  Other columns, of any name, pass through.  Rows
    that repeat id, text and source are one document, of which one row's other
    columns are kept; documents without words are not taken; an empty table
    gives no rows.
    """
    _, _, ranges = _mix(docs, id_col, text_col, source_col, weights, share, most, block_words, shard_slots, seed)
    names, cut = _worded(docs, ranges, id_col, text_col, source_col, ["pass"])
    whole = F.col("_row").getField(f"c{names.index(text_col)}")
    text = F.when(F.size("_all") == F.col("_words"), whole).otherwise(_some_words())
    return cut.select(*[text.alias(c) if c == text_col else F.col("_row").getField(f"c{k}").alias(c) for k, c in enumerate(names)])


def mixed_blocks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                 weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST,
                 block_words: int = BLOCK_WORDS, shard_slots: int = SHARD_SLOTS, seed: int = 17) -> DataFrame:
    """The mix as it is drawn: ``shard, slot, source, doc_id, n_words, text``, the words a slot takes of each document.

    A slot's block may span documents, a row each.  Nulls, repeated rows and an
    empty table are handled as by :func:`mixed_documents`.
    """
    _, _, ranges = _mix(docs, id_col, text_col, source_col, weights, share, most, block_words, shard_slots, seed)
    names, cut = _worded(docs, ranges, id_col, text_col, source_col, ["shard", "slot"])
    field = {c: F.col("_row").getField(f"c{names.index(c)}") for c in (id_col, source_col)}
    return cut.select("shard", "slot", field[source_col].alias("source"), field[id_col].alias("doc_id"), F.col("_words").alias("n_words"), _some_words().alias("text"))
