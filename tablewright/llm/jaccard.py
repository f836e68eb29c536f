"""N-gram Jaccard join with token-combination prefixes.

Documents are sets of word shingles (tokens).  Two sets are linked when their
Jaccard similarity reaches ``threshold``; components of linked documents are
returned.

* Equal sets collapse to one node first.
* Tokens are ordered from rare to frequent and fall into classes by frequency:
  class 1 (rare) is indexed by single tokens, class 2 (frequent) by pairs,
  class 3 (very frequent) by triples of tokens.  A set of ``n`` tokens can lose
  at most ``e = n - ceil(threshold * n)`` of them in a partner.  Its prefix is
  extended until ``n1 + sum over groups of (tokens - (k - 1))`` exceeds ``e``:
  then no choice of ``e`` lost tokens spoils all its combinations.  Combinations
  are formed inside groups of tokens dealt by hash, so their number stays
  linear in the prefix.  The number of groups follows the smaller set's size
  level; a set emits combinations for each level a partner can have.
* Tokens of a single set come first in the order and match nothing, so a set
  with more than ``e`` of them has no partner and leaves.
* A bucket of one combination is never expanded into pairs.  Each member is
  checked against the bucket's centre (the set whose tokens are most common)
  and linked sets form components.  Only members of a centre's cell that ended
  in different components are compared again, in blocks, which loses no link.
* In a cell of many members that stay unlinked (pages of one template) that
  would be all pairs, so they meet by prefixes once more, in the order of
  token frequencies inside the cell: what makes them a cell is frequent there
  and comes last.  Of two linked sets the larger one's first
  ``n - ceil(t * n) + 1`` tokens and the smaller one's first
  ``n - ceil(2 * t / (1 + t) * n) + 1`` share one.  Sets of equal size with
  6/7 of their tokens in common are linked (at 0.75), so a template either
  links its pages or leaves their index prefixes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import drop_tables, parquet_table
from tablewright.llm.components import connected_components
from tablewright.llm.vectors import U64, mix, shingle_sets

FLUSH_TOKENS = 1_000_000   # tokens a task holds before it emits them
FLUSH_DOCS = 60_000        # documents likewise; their numbers in a flush take two bytes
PART_TOKENS = 2_000_000    # tokens of one counting group, about
PAIR_DF = 32               # class 2 from this document frequency on
HEAVY_SHARE = 0.01         # class 3 from this share of the documents on
BLOCK = 512                # sets of one side in a block comparison
LARGE_CELL = 4 * BLOCK ** 2  # comparisons of a cell beyond which its members meet by prefixes inside it
MEETINGS = 1_000_000       # equal tokens of two sides that are counted at a time
HEAVY_DF = 65_535          # stands for the frequency of class 3; counted frequencies stop below it


def _i64(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


# ------------------------------------------------------------- sets and heavy tokens
def _describe_sets(size: int):
    """Row per document (id, set size, 128-bit set key), and rows of locally common tokens."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["id", "th", "n", "k1", "k2", "df"]
        held: list[np.ndarray] = []
        total = 0

        def common() -> pa.RecordBatch | None:
            if not held:
                return None
            toks, counts = np.unique(np.concatenate(held), return_counts=True)
            hot = counts >= max(2, math.ceil(HEAVY_SHARE * len(held)))
            k = int(hot.sum())
            return pa.record_batch([pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64()), pa.nulls(k, pa.int32()),
                                    pa.array(_i64(toks[hot])), pa.nulls(k, pa.int64()), pa.array(counts[hot])], names=names)

        for batch in batches:
            n, k1, k2 = [], [], []
            for _, toks in shingle_sets(batch.column(2), size):
                n.append(len(toks))
                k1.append(np.add.reduce(toks, dtype=U64))
                k2.append(np.bitwise_xor.reduce(mix(toks + U64(1)), dtype=U64) if len(toks) else U64(0))
                if len(toks):
                    held.append(toks)
                    total += len(toks)
                if total >= FLUSH_TOKENS:
                    yield common()
                    held.clear()
                    total = 0
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(n, pa.int32()), pa.array(_i64(mix(np.array(k1, U64)))),
                                   pa.array(_i64(np.array(k2, U64))), pa.nulls(len(n), pa.int64())], names=names)
        if held:
            yield common()
    return run


# ------------------------------------------------------------- document frequencies
# Tokens travel in packed rows.  A flush is a run of documents of one task; its id is a hash of
# their keys, so a task that runs again emits the same rows.  Kinds of row:
TOKENS, HEAVY, DOCUMENTS = 0, 1, 2
# TOKENS: 2 bytes document number in the flush and 6 bytes token each; HEAVY: the same with
# 8-byte tokens; DOCUMENTS: key and set size of the flush's documents.
_ROW = "kind int, part int, flush long, documents binary, tokens binary, dfs binary"
_LOW = (1 << 48) - 1


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
    return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 6, kinds)],
                           names=["kind", "part", "flush", "documents", "tokens", "dfs"])


def _six(tokens: np.ndarray) -> bytes:
    """The low 48 bits of each token."""
    return tokens.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _from_six(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(raw, np.uint8).reshape(-1, 6)
    return out.reshape(-1).view("<u8")


def _identity(part: np.ndarray, low: np.ndarray) -> np.ndarray:
    """A token again as 64 bits, from its part and its low 48 bits."""
    return mix(mix(part + U64(1)) + low)


def _cuts(sorted_values: np.ndarray) -> np.ndarray:
    """Bounds of the runs of equal values."""
    if not len(sorted_values):
        return np.zeros(1, int)
    return np.flatnonzero(np.concatenate([[True], sorted_values[1:] != sorted_values[:-1], [True]]))


def _emit_tokens(size: int, parts: int, heavy: np.ndarray):
    """Tokens of every document, packed by token part; heavy tokens and the documents' keys pass by the counting."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def flush() -> pa.RecordBatch:
            n = np.array([len(t) for t in held], np.int32)
            node = mix(np.array([np.add.reduce(t, dtype=U64) for t in held], U64))
            name = int(_i64(mix(np.add.reduce(mix(node + np.arange(len(node), dtype=U64)), dtype=U64, keepdims=True)))[0])
            tok, doc = np.concatenate(held), np.repeat(np.arange(len(held), dtype=np.uint16), n)
            part = mix(tok) % U64(parts)
            spread = name % parts
            rows = [(DOCUMENTS, spread, name, node.tobytes(), n.tobytes(), b"")]
            hot = np.isin(tok, heavy)
            if hot.any():
                rows.append((HEAVY, spread, name, doc[hot].tobytes(), _identity(part[hot], tok[hot] & U64(_LOW)).tobytes(), b""))
                tok, doc, part = tok[~hot], doc[~hot], part[~hot]
            order = np.argsort(part, kind="stable")
            tok, doc, part = tok[order], doc[order], part[order]
            cuts = _cuts(part)
            rows += [(TOKENS, int(part[a]), name, doc[a:b].tobytes(), _six(tok[a:b]), b"") for a, b in zip(cuts[:-1], cuts[1:])]
            return _rows(rows)

        total = 0
        for batch in batches:
            for _, t in shingle_sets(batch.column(0), size):
                if len(t):
                    held.append(t)
                    total += len(t)
                if total >= FLUSH_TOKENS or len(held) == FLUSH_DOCS:
                    yield flush()
                    held.clear()
                    total = 0
        if held:
            yield flush()
    return run


def _count_tokens(table: pa.Table) -> pa.Table:
    """Frequency of every token of one part; entries of tokens that several documents share go back to their flushes."""
    kinds = table.column("kind").to_numpy()
    rows = [tuple(r.values()) for r in table.filter(pa.array(kinds != TOKENS)).to_pylist()]
    sent = table.filter(pa.array(kinds == TOKENS))
    if sent.num_rows:
        part = U64(sent.column("part")[0].as_py())
        tok = _from_six(b"".join(sent.column("tokens").to_pylist()))
        doc = np.frombuffer(b"".join(sent.column("documents").to_pylist()), np.uint16)
        width = np.array([len(x) // 2 for x in sent.column("documents").to_pylist()])
        flush = np.repeat(sent.column("flush").to_numpy(), width)
        order = np.argsort(tok, kind="stable")
        cuts = _cuts(tok[order])
        df = np.empty(len(tok), np.int64)
        df[order] = np.repeat(np.diff(cuts), np.diff(cuts))
        shared = np.flatnonzero(df > 1)
        shared = shared[np.argsort(flush[shared], kind="stable")]
        cuts = _cuts(flush[shared])
        ids, dfs = _identity(np.full(1, part, U64), tok), np.minimum(df, HEAVY_DF - 1).astype(np.uint16)
        for a, b in zip(cuts[:-1], cuts[1:]):
            at = shared[a:b]
            rows.append((TOKENS, 0, int(flush[at[0]]), doc[at].tobytes(), ids[at].tobytes(), dfs[at].tobytes()))
    return pa.Table.from_batches([_rows(rows)])


# ------------------------------------------------------------- prefixes and combinations
def errors_allowed(n: int, threshold: float) -> int:
    """Tokens of a set of ``n`` that a partner may lack."""
    return n - math.ceil(threshold * n - 1e-9)


def combination_keys(tok: np.ndarray, df: np.ndarray, n: int, threshold: float) -> list[int]:
    """Index keys of one set, from its tokens that other sets share, rarest first.

    The ``n - len(tok)`` tokens that no other set has stand before them in the
    order and count as singles that match nothing.
    """
    allowed = errors_allowed(n, threshold)
    order = np.lexsort((tok, df))
    tok, df = tok[order], df[order]
    kinds = np.where(df == HEAVY_DF, 3, np.where(df >= PAIR_DF, 2, 1))
    smallest = max(1, math.ceil(threshold * n - 1e-9))
    keys: list[np.ndarray] = []
    for level in range(smallest.bit_length() - 1, n.bit_length()):
        groups = max(1, (1 << level) // 8)
        spread = (mix(tok + U64(level + 11)) % U64(groups)).astype(int)
        members: dict[tuple[int, int], list[int]] = {}
        covered, singles = n - len(tok), []
        for i in range(len(tok)):
            if covered > allowed:
                break
            k = int(kinds[i]) if level >= 3 else 1
            if k == 1:
                singles.append(i)
                covered += 1
            else:
                group = members.setdefault((k, int(spread[i])), [])
                group.append(i)
                covered += len(group) >= k
        keys.append(mix(tok[singles] + U64(level)))
        for (k, g), at in members.items():
            if len(at) >= k:
                picks = np.sort(tok[np.array(list(combinations(at, k)))], axis=1)
                key = np.full(len(picks), level * 1_000_003 + k * 1009 + g, U64)
                for j in range(k):
                    key = mix(key + picks[:, j])
                keys.append(key)
    return _i64(np.unique(np.concatenate(keys))).tolist() if keys else []


_SET = "node long, n int, score double, tokens array<long>, keys array<long>"


def _index_sets(threshold: float):
    """Sets of one flush that can have a partner, with their shared tokens and index keys."""
    def run(table: pa.Table) -> pa.Table:
        rows, nodes, sizes, docs, toks, dfs = [], None, None, [], [], []
        for r in table.to_pylist():
            if r["kind"] == DOCUMENTS:
                nodes, sizes = np.frombuffer(r["documents"], np.int64), np.frombuffer(r["tokens"], np.int32)
            else:
                docs.append(np.frombuffer(r["documents"], np.uint16))
                toks.append(np.frombuffer(r["tokens"], U64))
                dfs.append(np.frombuffer(r["dfs"], np.uint16) if r["kind"] == TOKENS else np.full(len(toks[-1]), HEAVY_DF, np.uint16))
        if docs:
            doc, tok, df = np.concatenate(docs), np.concatenate(toks), np.concatenate(dfs)
            order = np.argsort(doc, kind="stable")
            doc, tok, df = doc[order], tok[order], df[order]
            cuts = _cuts(doc)
            for a, b in zip(cuts[:-1], cuts[1:]):
                n = int(sizes[doc[a]])
                if b - a >= n - errors_allowed(n, threshold):
                    keys = combination_keys(tok[a:b], df[a:b], n, threshold)
                    rows.append((int(nodes[doc[a]]), n, float(df[a:b].sum(dtype=np.int64) / n), _i64(np.sort(tok[a:b])), keys))
        kinds = [pa.int64(), pa.int32(), pa.float64(), pa.list_(pa.int64()), pa.list_(pa.int64())]
        columns = list(zip(*rows)) if rows else [[]] * 5
        return pa.table([pa.array(list(c), t) for c, t in zip(columns, kinds)], names=["node", "n", "score", "tokens", "keys"])
    return run


# ------------------------------------------------------------- verification
def _linked(inter, n1, n2, threshold: float):
    """Jaccard at least the threshold, in whole numbers of hundredths."""
    return 100 * inter >= round(100 * threshold) * (n1 + n2 - inter)


def _compare_blocks(threshold: float):
    """Links between members of one block pair that lie in different components (a spanning set of them)."""
    def run(table: pa.Table) -> pa.Table:
        left = table.column("seeks").to_numpy(zero_copy_only=False)
        node, comp, n = (table.column(c).to_numpy() for c in ("node", "comp", "n"))
        lists = table.column("tokens").combine_chunks()
        tok, width = lists.flatten().to_numpy(), np.diff(lists.offsets.to_numpy())
        owner = np.repeat(np.arange(len(node)), width)
        seek, other = np.flatnonzero(left), np.flatnonzero(~left)
        slot = np.full(len(node), -1)
        slot[seek], slot[other] = np.arange(len(seek)), np.arange(len(other))
        mine = left[owner]
        order = np.argsort(tok[mine], kind="stable")
        index, index_owner = tok[mine][order], slot[owner[mine]][order]
        theirs, theirs_owner = tok[~mine], slot[owner[~mine]]
        lo, hi = np.searchsorted(index, theirs, "left"), np.searchsorted(index, theirs, "right")
        shared = np.zeros(len(seek) * len(other), np.int64)
        meetings = hi - lo
        ends = np.cumsum(meetings)
        s = 0
        while s < len(theirs):  # a bounded number of meetings at a time
            e = max(s + 1, int(np.searchsorted(ends, (ends[s - 1] if s else 0) + MEETINGS, "right")))
            reps = meetings[s:e]
            starts = np.repeat(lo[s:e] - np.concatenate([[0], np.cumsum(reps)[:-1]]), reps)
            hit = index_owner[starts + np.arange(reps.sum())]
            shared += np.bincount(np.repeat(theirs_owner[s:e], reps) * len(seek) + hit, minlength=len(shared))
            s = e
        shared = shared.reshape(len(other), len(seek))
        ok = (_linked(shared, n[other].astype(np.int64)[:, None], n[seek][None, :], threshold) & (shared > 0)
              & (comp[other][:, None] != comp[seek][None, :]))
        pairs, seen = [], set()
        for o, s in zip(*np.nonzero(ok)):
            both = tuple(sorted((int(comp[other[o]]), int(comp[seek[s]]))))
            if both not in seen:  # one link between two components is enough
                seen.add(both)
                pairs.append((int(node[other[o]]), int(node[seek[s]])))
        return pa.table([pa.array([p[i] for p in pairs], pa.int64()) for i in (0, 1)], names=["a", "b"])
    return run


def _late_links(cells: DataFrame, sets: DataFrame, components: DataFrame, threshold: float) -> DataFrame:
    """Links inside cells between members that the centres did not bring together."""
    placed = (cells.join(components.withColumnRenamed("node", "_n"), cells["node"] == F.col("_n"), "left")
              .select("centre", "node", F.coalesce("component", "node").alias("comp")))
    centres = components.select(F.col("node").alias("_c"), F.col("component").alias("main"))
    placed = (placed.join(centres, placed["centre"] == F.col("_c"), "left")
              .select("centre", "node", "comp", (F.col("comp") != F.coalesce("main", "centre")).alias("seeks")))
    # members outside the centre's component seek a partner among all members
    sizes = placed.groupBy(F.col("centre").alias("_c")).agg(F.count(F.lit(1)).alias("members"), F.count_if("seeks").alias("seekers"))
    sizes = sizes.where("seekers > 0 AND members > 1").select("_c", (F.col("members") * F.col("seekers") > LARGE_CELL).alias("large"))
    placed = parquet_table(placed.join(sizes, placed["centre"] == F.col("_c")).drop("_c"), "placed")
    small, large = placed.where("NOT large").withColumnRenamed("centre", "cell"), placed.where("large")
    seekers, members = small.where("seeks").select("cell", "node", "comp"), small.select("cell", "node", "comp")
    steps = [placed]
    if not large.isEmpty():
        entries = _inner_entries(large, sets, threshold)
        steps.append(entries)
        inner_seekers, inner_members = _inner_cells(entries)
        seekers, members = seekers.unionByName(inner_seekers), members.unionByName(inner_members)
    links = parquet_table(_block_links(seekers, members, sets, threshold), "late-links")
    drop_tables(*steps)
    return links


def _inner_entries(large: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Tokens in the probe prefix of each member of a large cell, in the cell's own order, and whether its index prefix has them.

    Tokens that no other member of the cell has are left out.
    """
    each = large.join(sets.select("node", "n", "tokens"), "node").select(
        "centre", "node", "comp", "seeks", "n", F.size("tokens").alias("held"), F.explode("tokens").alias("token"))
    local = each.groupBy(F.col("centre").alias("_c"), F.col("token").alias("_t")).agg(F.count(F.lit(1)).alias("local"))
    ordered = (each.join(local, (F.col("centre") == F.col("_c")) & (F.col("token") == F.col("_t")))
               .groupBy("centre", "node", "comp", "seeks", "n", "held")
               .agg(F.array_sort(F.collect_list(F.struct("local", "token"))).alias("tokens")))

    def prefix(share: float):
        """Length of the prefix without the tokens that no other set has, which stand first."""
        whole = F.col("n") - F.ceil(F.lit(share) * F.col("n") - F.lit(1e-6)) + 1
        return F.greatest(F.lit(0), whole - (F.col("n") - F.col("held"))).cast("int")

    entries = ordered.select("centre", "node", "comp", "seeks", prefix(2 * threshold / (1 + threshold)).alias("index"),
                             F.posexplode(F.slice("tokens", F.lit(1), prefix(threshold))).alias("at", "entry"))
    return parquet_table(entries.where("entry.local > 1").select(
        "centre", "node", "comp", "seeks", F.col("entry.token").alias("token"), (F.col("at") < F.col("index")).alias("indexed")), "inner")


def _inner_cells(entries: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Seekers and members of the cells that single tokens make inside large cells.

    A linked pair is in a cell of some token: one of the two has it in its
    index prefix, the other, not smaller, in its probe prefix, which is the
    index prefix and more.  Either may be the seeker, so a token makes two cells.
    """
    def cells(rows: DataFrame, role: int) -> DataFrame:
        return rows.select(F.xxhash64("centre", "token", F.lit(role)).alias("cell"), "node", "comp")

    indexed = entries.where("indexed")
    return (cells(indexed.where("seeks"), 0).unionByName(cells(entries.where("seeks"), 1)),
            cells(entries, 0).unionByName(cells(indexed, 1)))


def _block_links(seekers: DataFrame, members: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Links between the seekers and the members of every cell, compared in pairs of blocks."""
    rows = seekers.withColumn("seeks", F.lit(True)).unionByName(members.withColumn("seeks", F.lit(False)))
    sizes = rows.groupBy(F.col("cell").alias("_c")).agg(
        F.count_if("seeks").alias("seekers"), F.count_if(~F.col("seeks")).alias("members"),
        F.min("node").alias("least"), F.max("node").alias("most"))
    sizes = sizes.where("seekers > 0 AND members > 0 AND least < most").select(
        "_c", F.ceil(F.col("members") / BLOCK).cast("int").alias("blocks"), F.ceil(F.col("seekers") / BLOCK).cast("int").alias("seek_blocks"))
    placed = rows.join(sizes, rows["cell"] == F.col("_c")).drop("_c")

    def block(n: str):
        return F.pmod(F.xxhash64("node"), F.col(n)).cast("int")

    def every(n: str):
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    left = placed.where("seeks").select("cell", "node", "comp", "seeks", block("seek_blocks").alias("sb"), every("blocks").alias("mb"))
    right = placed.where("NOT seeks").select("cell", "node", "comp", "seeks", block("blocks").alias("mb"), every("seek_blocks").alias("sb"))
    both = left.unionByName(right).join(sets.select("node", "n", "tokens"), "node")
    return both.groupBy("cell", "sb", "mb").applyInArrow(_compare_blocks(threshold), "a long, b long")


# ------------------------------------------------------------- the join
def _in_set_order(texts: DataFrame) -> DataFrame:
    """``text`` ordered by its hash in every task: a flush is named by its documents in their
    order, so a task that runs again behind a shuffle needs the order it had."""
    return texts.select("text", F.xxhash64("text").alias("th")).sortWithinPartitions("th").select("text")


def jaccard_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.75,
                   shingle: int = 5) -> DataFrame:
    """``id, th, n, grp, component_id`` for every row of ``docs``.

    ``th`` is the text's hash, ``n`` the size of the row's set, ``grp`` a key of
    its component (null without words) and ``component_id`` the smallest id
    reachable by links, itself included.  Rows without words have no shingle
    and are linked with nothing.  Rows that repeat an id are nodes of their own
    text.  Rows with a null id are linked like others; a component in which
    no row has an id is null.  Other columns are ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(F.coalesce(text_col, F.lit(""))).alias("th"),
                        F.col(text_col).alias("text"))
    described = parquet_table(texts.mapInArrow(_describe_sets(shingle), "id long, th long, n int, k1 long, k2 long, df long"),
                              "sets")
    rows = described.where("n IS NOT NULL").drop("df")
    nodes = parquet_table(rows.where("n > 0").groupBy("k1", "k2", "n").agg(F.min("id").alias("id")), "nodes")
    totals = nodes.agg(F.sum("n"), F.count(F.lit(1))).first()
    tokens, n_nodes = totals[0] or 0, totals[1]
    # at most 1 / HEAVY_SHARE times the mean set size, whatever the number of documents
    n_rows = rows.where("n > 0").count()
    heavy = (described.where("df IS NOT NULL").groupBy("k1").agg(F.sum("df").alias("df"))
             .where(F.col("df") >= max(PAIR_DF, HEAVY_SHARE * n_rows)).select("k1").toArrow().column(0).to_numpy())
    parts = max(4 * width, math.ceil(tokens / PART_TOKENS))
    # one row of every set: without the copies of another row's set, and one of rows that repeat an id and its text
    copies = rows.where("n > 0").join(nodes.select(F.col("k1").alias("_k1"), F.col("k2").alias("_k2"), F.col("id").alias("_id")),
                                      (F.col("k1") == F.col("_k1")) & (F.col("k2") == F.col("_k2")) & (F.col("id") != F.col("_id")))
    repeats = parquet_table(rows.where("n > 0 AND id IS NOT NULL").groupBy("id", "th").agg(F.count(F.lit(1)).alias("rows"))
                            .where("rows > 1").select("id", "th"), "repeats")
    left_out = parquet_table(copies.select("id", "th").union(repeats).distinct(), "left-out")
    one = texts.where("id IS NOT NULL").join(left_out, ["id", "th"], "left_anti").select("text")
    if not repeats.isEmpty():
        firsts = repeats.join(copies.select("id", "th"), ["id", "th"], "left_anti")
        one = one.unionByName(texts.join(firsts, ["id", "th"], "left_semi").dropDuplicates(["id", "th"]).select("text"))
    no_id = nodes.where("id IS NULL")
    if not no_id.isEmpty():  # sets that only rows without an id have
        firsts = (rows.where("n > 0 AND id IS NULL").join(no_id.select("k1", "k2"), ["k1", "k2"], "left_semi")
                  .groupBy("k1", "k2").agg(F.min("th").alias("th")).select("th"))
        one = one.unionByName(texts.where("id IS NULL").dropDuplicates(["th"]).join(firsts, "th", "left_semi").select("text"))
    sent = _in_set_order(one).mapInArrow(_emit_tokens(shingle, parts, np.sort(heavy.view(U64))), _ROW)
    counted = sent.groupBy("part").applyInArrow(_count_tokens, _ROW)
    sets = parquet_table(counted.groupBy("flush").applyInArrow(_index_sets(threshold), _SET), "index")

    keyed = sets.select("node", "score", F.explode("keys").alias("key"))
    best = (keyed.groupBy("key").agg(F.max(F.struct("score", "node")).alias("best"), F.count(F.lit(1)).alias("rows"))
            .where("rows > 1").select("key", F.col("best.node").alias("centre")))
    cells = keyed.join(best, "key").where("centre <> node").select("centre", "node").distinct()
    x = sets.select("node", "n", "tokens")
    c = sets.select(F.col("node").alias("centre"), F.col("n").alias("cn"), F.col("tokens").alias("ct"))
    near = cells.join(x, "node").join(c, "centre")
    fits = F.least("n", "cn") * 100 >= round(100 * threshold) * F.greatest("n", "cn")
    inter = F.when(fits, F.size(F.array_intersect("tokens", "ct"))).otherwise(0)
    cells = parquet_table(near.select("centre", "node", _linked(inter.cast("long"), F.col("n"), F.col("cn"), threshold).alias("linked")),
                          "cells")
    links = cells.where("linked").select(F.col("centre").alias("a"), F.col("node").alias("b"))
    first = connected_components(links)
    late = _late_links(cells, sets, first, threshold)
    found = connected_components(links.unionByName(late))
    drop_tables(first, late, cells, sets, left_out, repeats)

    named = nodes.join(found.withColumnRenamed("node", "_n"), nodes["k1"] == F.col("_n"), "left").select(
        "k1", "k2", "id", F.coalesce("component", "k1").alias("grp"))
    smallest = named.groupBy("grp").agg(F.min("id").alias("component_id"))
    named = named.join(smallest, "grp").select(F.col("k1").alias("_k1"), F.col("k2").alias("_k2"), "grp", "component_id")
    return (rows.join(named, (F.col("k1") == F.col("_k1")) & (F.col("k2") == F.col("_k2")) & (F.col("n") > 0), "left")
            .select("id", "th", F.col("n").cast("long").alias("n"), "grp",
                    F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id")))


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.75,
                       shingle: int = 5) -> DataFrame:
    """``id_col, n_shingles, component_id`` for every row of ``docs`` (see :func:`jaccard_groups`)."""
    return jaccard_groups(docs, id_col, text_col, threshold, shingle).select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id")


def one_of_each_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.75,
                      shingle: int = 5) -> DataFrame:
    """``docs`` with one row of every component, the one with the smallest id (null ids last, then text hash).

    Rows without words all stay.
    """
    groups = jaccard_groups(docs, id_col, text_col, threshold, shingle)
    first = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "th"))
    kept = groups.where("n > 0").groupBy("grp").agg(first.alias("_f")).select(F.col("_f.id").alias("_kid"), F.col("_f.th").alias("_kth"))
    th = F.xxhash64(F.coalesce(text_col, F.lit("")))
    has_word = F.coalesce(F.rlike(F.col(text_col), F.lit(r"[^\x20\x09-\x0D]")), F.lit(False))
    with_words, without = docs.where(has_word), docs.where(~has_word)
    same = F.col(id_col).cast("long").eqNullSafe(F.col("_kid")) & (th == F.col("_kth"))
    return with_words.join(kept, same, "left_semi").dropDuplicates([id_col, text_col]).unionByName(without)


ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents WHERE text IS NOT NULL
), s AS (
  SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 4), ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM w WHERE len(w) > 0)
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.s = b.s AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id
), links AS (
  SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)
), reach AS (
  SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(r.m, d.doc_id)) AS component_id
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id
LEFT JOIN (SELECT a, min(b) AS m FROM reach GROUP BY a) r ON r.a = d.doc_id
"""
