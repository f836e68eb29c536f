"""Document fingerprints from closed syncmers over words.

The text is lower-cased and cut into tokens (words, longer words in pieces).
Of every ``K`` consecutive tokens the ``S``-token windows are hashed; the
K-window is chosen when its smallest S-hash stands at its first or its last
place.  The choice depends on the window's own tokens only, never on what
stands around it, so an unchanged passage always gives the same anchors.  A
fingerprint is the list of the chosen windows' hashes in text order.  A text
of K to 2 * K - S - 1 tokens may have no chosen window; with ``fallback`` the
hash of all its tokens is its anchor.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewright.llm.common import let, parquet_table

K, S = 8, 2
# A document's key, in ascending order: whether it has an id, the id (0 for none), the text's hash.
ORDER = ["_some", "_id", "_th"]
TOKEN = r"[^\x20\x09-\x0D]{1,12}"


def anchors(text: Column, k: int = K, s: int = S, fallback: bool = False) -> Column:
    """Hashes (int) of the closed syncmers of ``text`` in text order.

    A text with fewer than ``k`` tokens has one anchor, the hash of them all;
    a text without tokens (or null) has none.  With ``fallback`` a text of
    ``k`` or more tokens without a chosen window has that one anchor too.
    """
    inner = k - s  # the last place of an S-window in a K-window

    def chosen(h: Column, m: Column) -> Column:
        edge = lambda i: F.least(F.get(m, i), F.get(m, i + inner))
        within = lambda i: F.least(*[F.get(m, i + j) for j in range(1, inner)])
        starts = F.filter(F.sequence(F.lit(0), F.size(h) - k), lambda i: edge(i) <= within(i))
        return F.transform(starts, lambda i: F.hash(*[F.get(h, i + j) for j in range(k)]))

    def of_hashes(h: Column) -> Column:
        mers = F.transform(F.sequence(F.lit(0), F.size(h) - s), lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(s)]))
        found = let(mers, lambda m: chosen(h, m))
        if fallback:
            found = let(found, lambda a: F.when(F.size(a) == 0, F.array(F.hash(h))).otherwise(a))
        return (F.when(F.size(h) == 0, F.array().cast("array<int>"))
                .when(F.size(h) < k, F.array(F.hash(h)))
                .otherwise(found))

    tokens = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(TOKEN), F.lit(0))
    return let(F.transform(tokens, lambda t: F.xxhash64(t)), of_hashes)


def as_text(found: Column) -> Column:
    """The anchors as one string of eight hex digits each, in text order."""
    return F.array_join(F.transform(found, lambda x: F.lpad(F.hex(x.bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of the anchors; two fingerprints without anchors are alike."""
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, 1.0).otherwise(F.size(F.array_intersect(a, b)) / union)


def _neighbours(keys: DataFrame) -> DataFrame:
    """For each document key its predecessor's key and length in ascending id order (cyclic).

    The keys (no texts) are dealt by range; each range numbers its own rows
    and only one row per range is needed to link the ranges.
    """
    dealt = parquet_table(keys.repartitionByRange(*ORDER).withColumn("_part", F.spark_partition_id()), "fingerprint-order")
    order = Window.partitionBy("_part").orderBy(*ORDER)
    me = F.struct("_some", "_id", "_th", "_n")
    last = dealt.groupBy("_part").agg(F.max(me).alias("_last"))
    every = Window.partitionBy(F.lit(0))
    links = last.select("_part", F.coalesce(F.lag("_last").over(every.orderBy("_part")),
                                            F.last("_last").over(every.orderBy("_part").rowsBetween(
                                                Window.unboundedPreceding, Window.unboundedFollowing))).alias("_before"))
    return (dealt.withColumn("_prev", F.lag(me).over(order)).join(links, "_part")
            .select(*ORDER, "_n", F.coalesce("_prev", "_before").alias("_prev")))


def fingerprint_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fallback: bool = False) -> DataFrame:
    """Fingerprints of every document and of its edited text.

    The edited text has the last ``floor(n_chars / 2)`` code points replaced by
    the first as many (or all) of the next document in ascending id order,
    ties by text hash; after the last comes the first.  Returns ``id_col,
    n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next``.  Null texts are empty, null ids sort first.  Rows that repeat
    an id and its text are one document and give one row each; other columns
    are ignored.  Only with ``fallback`` has every text with tokens an anchor;
    without it different texts of few tokens can be alike for having none.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    keyed = docs.select(F.col(id_col).isNotNull().alias("_some"), F.coalesce(id_col, F.lit(0)).cast("long").alias("_id"),
                        F.xxhash64(text).alias("_th"), text.alias("_text"))
    around = _neighbours(keyed.groupBy(*ORDER).agg(F.max(F.length("_text")).alias("_n")))
    whole = keyed.join(around, ORDER).select(*ORDER, "_text", "_n", "_prev", anchors(F.col("_text"), fallback=fallback).alias("_anchors"))
    # what each document gives its predecessor; rows that repeat a document give the same
    gives = whole.select(*[F.col(f"_prev.{k}").alias(k) for k in ORDER],
                         F.struct(F.left("_text", F.floor(F.col("_prev._n") / 2).cast("int")).alias("tail"),
                                  F.col("_anchors").alias("next")).alias("_g"))
    gives = gives.groupBy(*ORDER).agg(F.first("_g").alias("_g"))
    half = F.floor(F.col("_n") / 2).cast("int")
    edited = whole.join(gives, ORDER).select(
        F.when(F.col("_some"), F.col("_id")).alias("_id"), "_n", "_anchors", F.col("_g.next").alias("_next"),
        F.concat(F.left("_text", F.col("_n") - half), F.col("_g.tail")).alias("_edited"))
    both = edited.select("_id", "_n", "_anchors", "_next", F.sha2("_edited", 256).alias("_sha"),
                         anchors(F.col("_edited"), fallback=fallback).alias("_after"))
    return both.select(F.col("_id").alias(id_col), F.col("_n").cast("long").alias("n_chars"), F.col("_sha").alias("edited_sha256"),
                       as_text(F.col("_anchors")).alias("fingerprint"), as_text(F.col("_after")).alias("edited_fingerprint"),
                       likeness(F.col("_anchors"), F.col("_after")).alias("near_edited"),
                       likeness(F.col("_anchors"), F.col("_next")).alias("near_next"))
