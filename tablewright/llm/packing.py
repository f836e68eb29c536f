"""Packing documents into sequences: first-fit decreasing over a tournament tree.

A document becomes its token ids and a closing id 0.  Pieces of a full
sequence are cut off the front and stand alone; what remains of each document
is dealt by hash to groups of about ``group_docs`` documents.  Inside a group
the remainders are placed, longest first, into the first bin with room.  The
bins' free places are the leaves of a tournament tree whose inner nodes hold
the larger child, so the first bin with room is found in log(bins) steps.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SEQUENCE = 1024
GROUP_DOCS = 4096
END_ID = 0


class FirstFit:
    """Bins of equal capacity; ``place`` puts an item into the first bin with room."""

    def __init__(self, bins: int, capacity: int) -> None:
        self.leaves = 1 << max(1, bins - 1).bit_length()
        self.room = [capacity] * (2 * self.leaves)

    def place(self, length: int) -> tuple[int, int]:
        """Bin and the room it had before."""
        room, at = self.room, 1
        while at < self.leaves:
            at *= 2
            if room[at] < length:
                at += 1
        before = room[at]
        room[at] -= length
        leaf = at - self.leaves
        at //= 2
        while at:
            most = max(room[2 * at], room[2 * at + 1])
            if room[at] == most:
                break
            room[at] = most
            at //= 2
        return leaf, before


def first_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Bin and offset of every item, and the number of bins; ties go by position."""
    order = np.argsort(-lengths, kind="stable")
    fit = FirstFit(max(1, len(lengths)), capacity)
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    for i, n in zip(order.tolist(), lengths[order].tolist()):
        b, room = fit.place(n)
        bins[i], offsets[i] = b, capacity - room
    return bins, offsets, int(bins.max()) + 1 if len(bins) else 0


_ENCODERS: dict[str, object] = {}


def encoder(path: str):
    """Byte-level BPE encoder of the public rank file at ``path`` (one per worker)."""
    if path not in _ENCODERS:
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, lines)}
        _ENCODERS[path] = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _ENCODERS[path]


_PIECES = "doc_id long, th long, start long, length long, ids_crc32 long, doc_tokens long"


def _token_pieces(path: str, sequence: int):
    """One row per piece: full sequences first, then the remainder."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).encode_ordinary
        for batch in batches:
            rows: list[tuple] = []
            for doc, th, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                ids = np.array(encode(text.as_py() or "") + [END_ID], "<u4")
                for a in range(0, len(ids), sequence):
                    piece = ids[a:a + sequence]
                    rows.append((doc, th, a, len(piece), zlib.crc32(piece.tobytes()), len(ids)))
            yield pa.record_batch([pa.array(c, pa.int64()) for c in (zip(*rows) if rows else [[]] * 6)],
                                  names=["doc_id", "th", "start", "length", "ids_crc32", "doc_tokens"])
    return run


def _pack_group(sequence: int):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["doc_id", "th", "start"], kind="stable", na_position="first").reset_index(drop=True)
        bins, offsets, _ = first_fit_decreasing(group["length"].to_numpy(), sequence)
        return group.assign(sequence_id=(group["grp"].to_numpy(np.int64) << 32) + bins, offset=offsets).drop(columns=["grp", "th"])
    return run


def pack_documents(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                   sequence: int = SEQUENCE, group_docs: int = GROUP_DOCS) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    Pieces of a sequence stand without gaps from offset 0.  A null or empty
    text is the closing id alone.  Repeated rows are packed each; ids may be
    null; other columns are ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.coalesce(text_col, F.lit(""))).alias("th"),
                        F.coalesce(text_col, F.lit("")).alias("text"))
    groups = max(1, -(-docs.count() // group_docs))
    pieces = texts.mapInArrow(_token_pieces(tokenizer_path, sequence), _PIECES)
    pieces = pieces.withColumn("grp", F.pmod(F.xxhash64("doc_id", "th", "start"), F.lit(groups)))
    return pieces.groupBy("grp").applyInPandas(
        _pack_group(sequence), "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
