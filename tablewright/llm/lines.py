"""Line dedup across documents: deletion-neighbourhood join over words.

Two lines are duplicates when their word sequences are equal, or, from
``min_words`` words on (those of the longer one), when at most ``edits`` words
inserted, deleted or replaced turn one into the other.  Of duplicate lines the
earliest, by ``(doc_id, text hash, line number)``, stays.

1. Equal lines meet on a 128-bit hash of their words; a partial aggregate
   keeps the earliest occurrence, so a line that every document holds reduces
   to one row per task.
2. One edit leaves the first or the second half of the shorter line's word
   count untouched.  Each distinct line is keyed by both halves, for either
   length a partner can have; a key that two lines share tells on which side
   the edit must lie and which of the two may be the longer one.  Lines that
   share no key have no neighbour and leave; nothing is lost.
3. The rest emit their variants as hashed keys, only for edits outside a half
   they share: the line with one word left open (a replacement) where a line
   of equal length shares the half, with one word deleted where a shorter one
   does, whole where a longer one does.  Equal keys of matching kinds are
   exactly one edit apart.  Each key needs only the earliest of each kind, so
   variants are aggregated, never paired.
4. The pairs (line, earliest neighbour) are checked word by word.

With ``edits`` above 1 the untouched part may be shifted, so all lines emit
the variants with up to that many words deleted or left open; a key holds the
earliest line for each number of deletions, and variants match when deletions
of both and open places together are within the bound.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import SPACE, drop_tables, let, parquet_table

DOC = ["_id", "_th"]
_LONGS = "array<bigint>"


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("_id"), F.xxhash64(text).alias("_th"), text.alias("_text"))


def _normal(line: Column) -> Column:
    """The line's words with one blank between them."""
    odd = F.rlike(line, F.lit(r"^\x20|\x20$|\x20\x20|[\x09-\x0D]"))
    return F.when(odd, F.trim(F.regexp_replace(line, SPACE, " "))).otherwise(line)


def _lines(keyed: DataFrame) -> DataFrame:
    """Lines that have a word: document key, position, normal form, number of words."""
    each = keyed.select(*DOC, F.posexplode(F.split("_text", "\n")).alias("_pos", "_raw")).where(F.length("_raw") > 0)
    normal = each.select(*DOC, "_pos", _normal(F.col("_raw")).alias("_line")).where(F.length("_line") > 0)
    return normal.select(*DOC, "_pos", "_line", (F.length("_line") - F.length(F.replace("_line", F.lit(" "), F.lit(""))) + 1).alias("_n"))


def _half_keys(line: Column, n: Column) -> Column:
    """Keys of the untouched halves, as the shorter (length n) and as the longer line (n - 1)."""
    def halves(m: Column) -> list[Column]:
        a = F.floor(m / 2).cast("int")
        return [F.xxhash64(m, F.lit(0), F.call_function("substring_index", line, F.lit(" "), a)),
                F.xxhash64(m, F.lit(1), F.call_function("substring_index", line, F.lit(" "), a - m))]
    return F.array(*halves(n), *halves(n - 1))


def _candidate_lines(keyed: DataFrame, candidates: DataFrame) -> DataFrame:
    """Words of the candidates, fetched at their first occurrence and numbered in order of occurrence.

    ``_o, _k1, _k2, _w, _m``: ``_o`` grows with the first occurrence, because the
    rows are dealt by range and numbered partition by partition.
    """
    where = (candidates.groupBy(*DOC).agg(F.collect_list(F.struct("_pos", "_k1", "_k2", "_m")).alias("_at"))
             .withColumnsRenamed({"_id": "_cid", "_th": "_cth"}))
    docs = keyed.join(where, F.col("_id").eqNullSafe(F.col("_cid")) & (F.col("_th") == F.col("_cth")))
    # through a generator, so that the text is split once and not again for every position
    docs = docs.select(*DOC, "_at", F.explode(F.array(F.split("_text", "\n"))).alias("_parts"))
    found = docs.select(*DOC, F.explode(F.transform(
        "_at", lambda c: F.struct(c.alias("c"), F.get(F.col("_parts"), c["_pos"]).alias("line")))).alias("_c"))
    once = found.select(*DOC, F.col("_c.c._pos").alias("_pos"), F.col("_c.c._k1").alias("_k1"), F.col("_c.c._k2").alias("_k2"), F.col("_c.c._m").alias("_m"),
                        F.split(_normal(F.col("_c.line")), " ").alias("_w")).dropDuplicates(["_k1", "_k2"])
    order = ["_id", "_th", "_pos"]
    return once.repartitionByRange(*order).sortWithinPartitions(*order).select(
        F.monotonically_increasing_id().alias("_o"), "_k1", "_k2", "_w", "_m")


def _xor(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda a, x: a.bitwiseXOR(x))


def _running_xor(values: Column) -> Column:
    """XOR of each value with all before it, by doubling: as many rounds as the length has bits."""
    rounds = F.sequence(F.lit(0), F.ceil(F.log2(F.size(values) + 1)).cast("int"))
    return F.aggregate(rounds, values, lambda acc, r: F.transform(
        acc, lambda x, i: x.bitwiseXOR(F.coalesce(F.get(acc, i - F.call_function("shiftleft", F.lit(1), r)), F.lit(0).cast("long")))))


# sides on which a line's edit may lie, by the key it shares: bits of a line's mask
OPEN_LATE, OPEN_EARLY, DROP_LATE, DROP_EARLY, WHOLE = 1, 2, 4, 8, 16


def _part(values: Column, mask: Column, late: int, early: int, a: Column, ends: Column) -> tuple[Column, Column]:
    """Those of ``values`` from place ``a`` on (bit ``late``) or before ``ends`` (bit ``early``), and the place of the first."""
    is_late, is_early = mask.bitwiseAND(late) != 0, mask.bitwiseAND(early) != 0
    start = F.when(is_early, 0).otherwise(a)
    stop = F.when(is_late, F.size(values)).when(is_early, ends).otherwise(a)
    return F.slice(values, start + 1, stop - start), start


def _variants(words: Column, mask: Column) -> Column:
    """Keys of a line's variants as ``(h1, h2, kind)``, those that ``mask`` asks for.

    A line's hash is the XOR of its words' hashes with their places.  Deleting
    word ``i`` and closing the gap moves the later words one place down: the
    hash is that of all words one place down, XOR word ``i`` in its place, XOR
    the running XOR of both placings up to ``i``.
    Kind 0: the whole line; 1: the line without one word; 2: the line with one
    word left open, its place being part of the key.
    """
    n = F.size(words)
    half, short = F.floor(n / 2).cast("int"), F.floor((n - 1) / 2).cast("int")

    def keys(seed: int) -> Column:
        def of(pair: Column) -> Column:
            here, down = pair["here"], pair["down"]
            both = F.zip_with(here, down, lambda a, b: a.bitwiseXOR(b))
            def done(x: Column) -> Column:
                whole, shift = x["whole"], x["shift"]
                gone = F.zip_with(here, x["run"], lambda a, r: a.bitwiseXOR(r))
                gone, _ = _part(gone, mask, DROP_LATE, DROP_EARLY, short, short + 1)
                opened, at = _part(here, mask, OPEN_LATE, OPEN_EARLY, half, half)
                return F.struct(
                    F.when(mask.bitwiseAND(WHOLE) != 0, F.array(F.xxhash64(n, F.lit(-1), whole))).otherwise(F.array().cast(_LONGS)).alias("w"),
                    F.transform(gone, lambda g: F.xxhash64(n - 1, F.lit(-1), shift.bitwiseXOR(g))).alias("d"),
                    F.transform(opened, lambda a, i: F.xxhash64(n, i + at, whole.bitwiseXOR(a))).alias("o"))
            run = F.when(mask.bitwiseAND(DROP_LATE | DROP_EARLY) != 0, _running_xor(both)).otherwise(here)
            return let(F.struct(_xor(here).alias("whole"), _xor(down).alias("shift"), run.alias("run")), done)
        return let(F.struct(F.transform(words, lambda w, i: F.xxhash64(F.lit(seed), w, i)).alias("here"),
                            F.transform(words, lambda w, i: F.xxhash64(F.lit(seed), w, i - 1)).alias("down")), of)

    def kind(k: Column, c: str, number: int) -> Column:
        return F.zip_with(k["a"][c], k["b"][c], lambda x, y: F.struct(x.alias("h1"), y.alias("h2"), F.lit(number).cast("byte").alias("kind")))

    return let(F.struct(keys(1).alias("a"), keys(2).alias("b")), lambda k: F.concat(kind(k, "w", 0), kind(k, "d", 1), kind(k, "o", 2)))


def near_removed(own: DataFrame) -> DataFrame:
    """Keys of lines in ``own`` (with their ``_m`` masks) that have a neighbour one word edit away which occurs earlier."""
    emitted = own.select("_o", F.explode(_variants(F.col("_w"), F.col("_m"))).alias("v"))
    variants = parquet_table(emitted.select("_o", "v.*"), "line-variants")
    kind = F.col("kind")
    met = (variants.groupBy("h1", "h2").agg(
        F.count(F.lit(1)).alias("rows"), F.min("_o").alias("any"), F.min(F.when(kind == 0, F.col("_o"))).alias("whole"),
        F.min(F.when(kind == 1, F.col("_o"))).alias("deleted")).where("rows > 1").drop("rows"))
    other = F.when(kind == 2, F.col("any")).when(kind == 1, F.col("whole")).otherwise(F.col("deleted"))
    near = (variants.join(met, ["h1", "h2"]).select("_o", other.alias("_p")).where("_p < _o")
            .groupBy("_o").agg(F.min("_p").alias("_p")))
    mine = own.select("_o", "_k1", "_k2", F.col("_w").alias("_mine"))
    theirs = own.select(F.col("_o").alias("_p"), F.col("_w").alias("_theirs"))
    pairs = near.join(mine, "_o").join(theirs, "_p")
    removed = parquet_table(pairs.where(within_one_word(F.col("_mine"), F.col("_theirs"))).select("_k1", "_k2"), "near-lines")
    drop_tables(variants)
    return removed


def near_removed_within(own: DataFrame, min_words: int, edits: int) -> DataFrame:
    """The same for any number of ``edits``: variants with up to ``edits`` words deleted or left open, from the left on.

    A line of n words has about ``(2 n) ** edits / edits!`` variants; an open word is null."""
    long = own.where(F.size("_w") >= min_words - edits)
    level = long.select("_o", F.size("_w").alias("n"), F.transform("_w", lambda w: F.struct(
        F.xxhash64(F.lit(1), w).alias("a"), F.xxhash64(F.lit(2), w).alias("b"))).alias("s"), F.lit(0).alias("p"), F.lit(0).alias("d"), F.lit(0).alias("r"))
    levels = [level]
    for _ in range(edits):
        size = F.size("s")
        each = level.where(F.col("p") < size).select("*", F.explode(F.sequence("p", size - 1)).alias("i"))
        before, after = F.slice("s", F.lit(1), F.col("i")), F.slice("s", F.col("i") + 2, size)
        mark = F.array(F.lit(None).cast("struct<a: bigint, b: bigint>"))
        both = F.array(F.struct(F.concat(before, after).alias("s"), F.col("i").alias("p"), (F.col("d") + 1).alias("d"), F.col("r").alias("r")),
                       F.struct(F.concat(before, mark, after).alias("s"), (F.col("i") + 1).alias("p"), F.col("d").alias("d"), (F.col("r") + 1).alias("r")))
        level = each.select("_o", "n", F.explode(both).alias("v")).select("_o", "n", "v.*")
        levels.append(level)
    keyed = [v.select("_o", "n", "d", "r", F.xxhash64(F.size("s"), F.transform("s", lambda x: F.struct(x["a"], x.isNull()))).alias("h1"),
                      F.xxhash64(F.size("s"), F.transform("s", lambda x: F.struct(x["b"], x.isNull()))).alias("h2")) for v in levels]
    variants = keyed[0]
    for v in keyed[1:]:
        variants = variants.unionByName(v)
    variants = parquet_table(variants, "line-variants")
    # the earliest line of each number of deletions, among those long enough to decide and among all
    firsts = [F.min(F.when((F.col("d") <= x) & ((F.col("n") >= min_words) | (F.lit(k) == 0)), F.col("_o"))).alias(f"f{x}_{k}")
              for x in range(edits + 1) for k in (0, 1)]
    met = variants.groupBy("h1", "h2", "r").agg(F.count(F.lit(1)).alias("rows"), *firsts).where("rows > 1").drop("rows")
    room = F.lit(edits) - F.col("d") - F.col("r")
    other = F.lit(None).cast("long")
    for x in range(edits + 1):
        other = F.when(room == x, F.when(F.col("n") >= min_words, F.col(f"f{x}_0")).otherwise(F.col(f"f{x}_1"))).otherwise(other)
    near = variants.join(met, ["h1", "h2", "r"]).where(other < F.col("_o")).select("_o").distinct()
    near = parquet_table(own.join(near, "_o", "left_semi").select("_k1", "_k2"), "near-lines")
    drop_tables(variants)
    return near


def within_one_word(a: Column, b: Column) -> Column:
    """Whether word arrays differ by at most one inserted, deleted or replaced word."""
    short = F.when(F.size(a) <= F.size(b), a).otherwise(b)
    long = F.when(F.size(a) <= F.size(b), b).otherwise(a)
    differ = F.filter(F.sequence(F.lit(0), F.size(short) - 1), lambda i: F.get(short, i) != F.get(long, i))
    at = F.coalesce(F.get(differ, F.lit(0)), F.size(short))
    rest = F.size(short) - at
    return F.when(F.size(short) == F.size(long), F.size(differ) <= 1).when(
        F.size(long) - F.size(short) == 1,
        F.slice(short, at + 1, rest) == F.slice(long, at + 2, rest)).otherwise(False)


def _candidates(distinct: DataFrame, min_words: int) -> DataFrame:
    """Lines that share a half with another one, with the mask of variants that can matter."""
    keys = distinct.select("_k1", "_n", F.posexplode("_h").alias("_j", "_half"))
    short, longer = F.col("_j") < 2, F.col("_j") >= 2
    shared = keys.groupBy("_half").agg(F.count_if(short).alias("_short"), F.count_if(longer).alias("_long")).where(
        "_short > 1 OR (_short > 0 AND _long > 0)")
    side = F.when(F.col("_j") == 0, OPEN_LATE).when(F.col("_j") == 1, OPEN_EARLY).when(F.col("_j") == 2, DROP_LATE).otherwise(DROP_EARLY)
    enough = F.col("_n") >= min_words  # of the longer line, and of both when a word is replaced
    opened = F.when(enough & (F.col("_short") > 1), side).otherwise(0).bitwiseOR(F.when(F.col("_long") > 0, WHOLE).otherwise(0))
    masks = keys.join(shared, "_half").select(
        "_k1", F.when(short, opened).otherwise(F.when(enough & (F.col("_short") > 0), side).otherwise(0)).alias("_m")).where("_m <> 0")
    return distinct.join(masks.groupBy("_k1").agg(F.bit_or("_m").alias("_m")), "_k1").drop("_h", "_n")


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = 8,
                counts: tuple[str, str] = ("n_lines", "n_removed"), edits: int = 1) -> DataFrame:
    """``docs`` with ``text_col`` reduced to its kept lines, plus the number of its
    lines with a word and of those removed, named by ``counts``.

    ``edits`` is the bound on word edits between near lines (0: equal lines
    only).  All other columns, of any name, pass through (input columns of the
    names in ``counts`` are replaced).  Lines without a word always stay.  Rows
    that repeat a document (same id and text) are the same document and get the
    same text.  Null ids sort first; a null text stays null and counts as empty;
    an empty table gives an empty result.
    """
    if edits < 0:
        raise ValueError("edits is 0 or more")
    columns = [c for c in docs.columns if c not in counts]
    # columns that are not used travel in a struct, so their names can't clash with those below
    docs = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("_text"), F.struct(
        F.lit(0).alias("_"), *[F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(columns)]).alias("_rest"))
    keyed = _keyed(docs, "_id", "_text")
    line = F.col("_line")
    halves = F.when(F.col("_n") >= min_words - 1, _half_keys(line, F.col("_n"))) if edits == 1 else F.lit(None).cast(_LONGS)
    hashed = _lines(keyed).select(*DOC, "_pos", "_n", halves.alias("_h"), F.xxhash64(line).alias("_k1"),
                                  F.xxhash64(F.lit(7), line).alias("_k2"))
    distinct = parquet_table(hashed.groupBy("_k1", "_k2").agg(F.min(F.struct(*DOC, "_pos")).alias("_f"), F.first("_h").alias("_h"), F.first("_n").alias("_n"))
                             .select("_k1", "_k2", "_f.*", "_h", "_n"), "distinct-lines")
    last = distinct
    if edits:
        candidates = _candidates(distinct, min_words) if edits == 1 else distinct.where(F.col("_n") >= min_words - edits).select(
            "_k1", "_k2", *DOC, "_pos", F.lit(0).alias("_m"))
        candidates = parquet_table(candidates, "candidates")
        own = parquet_table(_candidate_lines(keyed, candidates), "candidate-lines")
        near = near_removed(own) if edits == 1 else near_removed_within(own, min_words, edits)
        drop_tables(candidates, own)
        last = distinct.join(near, ["_k1", "_k2"], "left_anti")
    kept = (last.groupBy(*DOC).agg(F.collect_list("_pos").alias("_kept"))
            .withColumnsRenamed({"_id": "_kid", "_th": "_kth"}))
    text = F.coalesce(F.col("_text"), F.lit(""))
    joined = docs.withColumn("_th", F.xxhash64(text)).join(
        kept, F.col("_id").eqNullSafe(F.col("_kid")) & (F.col("_th") == F.col("_kth")), "left")
    parts = joined.select("_text", "_rest", "_kept", F.explode(F.array(F.split(text, "\n"))).alias("_parts"))
    blank = F.filter(F.transform("_parts", lambda x, i: F.when(~F.rlike(x, F.lit(r"[^\x20\x09-\x0D]")), i)),
                     lambda i: i.isNotNull())
    parts = parts.withColumns({"_kept": F.coalesce("_kept", F.array().cast("array<int>")), "_blank": blank})
    rest = F.array_join(F.transform(F.array_sort(F.concat("_kept", "_blank")),
                                    lambda i: F.get(F.col("_parts"), i)), "\n")
    n_lines = F.size("_parts") - F.size("_blank")
    return parts.select(*[F.when(F.col("_text").isNotNull(), rest).alias(c) if c == text_col else F.col("_rest").getField(f"c{k}").alias(c)
                          for k, c in enumerate(columns)],
                        n_lines.cast("long").alias(counts[0]),
                        (n_lines - F.size("_kept")).cast("long").alias(counts[1]))


ORACLE = r"""
WITH w AS (
  SELECT doc_id, pos, list_filter(string_split_regex(line, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
               unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos FROM documents)
), l AS (SELECT doc_id, pos, w, len(w) AS n FROM w WHERE len(w) > 0),
d AS (SELECT w, n, min(struct_pack(i := doc_id, p := pos)) AS f FROM l GROUP BY w, n),
v AS (
  SELECT w, f, n, k, list_slice(w, 1, k - 1) || list_slice(w, k + 1, n) AS rest
  FROM (SELECT w, f, n, unnest(range(1, n + 1)) AS k FROM d WHERE n >= 8)
), near AS (
  SELECT w FROM (SELECT w, f, min(f) OVER (PARTITION BY n, k, rest) AS g FROM v) WHERE g < f
  UNION SELECT v.w FROM v JOIN d ON d.w = v.rest WHERE d.f < v.f
  UNION SELECT d.w FROM v JOIN d ON d.w = v.rest WHERE v.f < d.f
), kept AS (SELECT f FROM d WHERE NOT EXISTS (SELECT 1 FROM near WHERE near.w = d.w)),
marked AS (
  SELECT a.doc_id, a.pos, a.line, l.pos IS NOT NULL AS is_line,
         l.pos IS NULL OR struct_pack(i := a.doc_id, p := a.pos) IN (SELECT f FROM kept) AS stays
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
               unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos FROM documents) a
  LEFT JOIN l ON l.doc_id = a.doc_id AND l.pos = a.pos
)
SELECT d.doc_id, CASE WHEN d.text IS NOT NULL THEN coalesce(m.text, '') END AS text, m.n_lines, m.n_removed
FROM documents d JOIN (
  SELECT doc_id, string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE stays) AS text,
         count(*) FILTER (WHERE is_line) AS n_lines, count(*) FILTER (WHERE NOT stays) AS n_removed
  FROM marked GROUP BY doc_id) m ON m.doc_id = d.doc_id
"""
