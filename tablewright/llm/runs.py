"""Periodic run detection by recursive frequency splitting and a lag scan.

A run is a longest stretch of consecutive words in which words ``q`` apart are
identical, ``q`` being its smallest period, of ``max(min_length, times * q)``
words or more.  Each of its words occurs ``times`` times or more inside it, so
a word that is rarer than that within a segment of the text lies in no run of
the segment and splits it.  The parts are split again, by the counts within
each part, until nothing changes: a run always lies whole in one part.  Only
the parts that are left are scanned lag by lag.

The lag scan compares words on a grid of step ``q`` first.  A run has
``times - 1`` equal neighbours or more on it, wherever it starts, so a segment
of ``m`` words costs about ``m ln m`` comparisons; only where the grid holds
that many are all words compared.  What a found run with a period that divides
``q`` covers is not looked at again (it can hold no other run of lag ``q``).

No row meets another one: no shuffle, and the work of a task is the texts of
its rows, a few megabytes at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from tablewright.llm.vectors import _SPACE, text_steps

RUN = StructType([StructField(c, LongType(), False) for c in ("start", "length", "period")])


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and end byte of every word, and the index of each row's first word (one more at the end)."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    space = _SPACE[data]
    starts, ends = ~space, ~space
    starts[1:] &= space[:-1]
    ends[:-1] &= space[1:]
    inner = offsets[(offsets > 0) & (offsets < len(data))]  # a row's edge ends a word too
    starts[inner] = ~space[inner]
    ends[inner - 1] = ~space[inner - 1]
    first = np.flatnonzero(starts)
    return first, np.flatnonzero(ends) + 1, np.searchsorted(first, offsets)


def word_codes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A number for each word, equal for equal words only."""
    lengths = np.concatenate([[0], np.cumsum(ends - starts)])
    held = data[~_SPACE[data]]
    words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(lengths.astype(np.int64)), pa.py_buffer(held)])
    return words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)


def split_segments(codes: np.ndarray, bounds: np.ndarray, min_length: int, times: int) -> list[tuple[int, int]]:
    """Segments ``(start, end)`` of the rows at ``bounds`` in which every word occurs ``times`` times or more.

    All segments of one depth are counted together; a segment without a rare
    word is stable and leaves.
    """
    n_codes = int(codes.max()) + 1 if len(codes) else 1
    place = np.arange(len(codes))
    segment = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    stable: list[tuple[int, int]] = []
    while len(place):
        # segments too short for any run go first
        edge = np.flatnonzero(np.concatenate([[True], segment[1:] != segment[:-1]]))
        size = np.diff(np.concatenate([edge, [len(place)]]))
        held = np.repeat(size >= min_length, size)
        place, segment = place[held], segment[held]
        if not len(place):
            break
        edge = np.flatnonzero(np.concatenate([[True], segment[1:] != segment[:-1]]))
        size = np.diff(np.concatenate([edge, [len(place)]]))
        _, which, counts = np.unique(segment * n_codes + codes[place], return_inverse=True, return_counts=True)
        frequent = counts[which] >= times
        whole = np.logical_and.reduceat(frequent, edge)
        stable += [(int(place[e]), int(place[e]) + int(s)) for e, s in zip(edge[whole], size[whole])]
        on = frequent & ~np.repeat(whole, size)
        place, segment = place[on], segment[on]
        new = (place[1:] != place[:-1] + 1) | (segment[1:] != segment[:-1])
        segment = np.concatenate([[0], np.cumsum(new)]) if len(place) else place
    return stable


def lag_scan(words: np.ndarray, min_length: int, times: int) -> list[tuple[int, int, int]]:
    """``(start, length, period)`` of every run of one segment."""
    runs: list[tuple[int, int, int]] = []
    places: set[tuple[int, int]] = set()
    known = np.zeros((0, 3), np.int64)  # start, end, period
    need = times - 1
    for q in range(1, len(words) // times + 1):
        grid = words[::q]
        same = grid[1:] == grid[:-1]
        hits = same[need - 1:]
        for k in range(1, need):
            hits = hits & same[need - 1 - k:len(same) - k]
        hits = np.flatnonzero(hits)
        if not len(hits):
            continue
        if len(known) != len(runs):
            known = np.array([(s, s + n, p) for s, n, p in runs], np.int64)
        for group in np.split(hits, np.flatnonzero(np.diff(hits) > 1) + 1):
            first, last = int(group[0]), int(group[-1]) + need - 1
            if len(known) and ((known[:, 0] <= first * q) & (known[:, 1] > (last + 1) * q) & (q % known[:, 2] == 0)).any():
                continue
            low, high = max(0, (first - 1) * q + 1), min(len(words) - q, (last + 1) * q)
            equal = np.concatenate([[False], words[low:high] == words[low + q:high + q], [False]])
            turns = np.flatnonzero(equal[1:] != equal[:-1]).reshape(-1, 2)
            for a, b in turns.tolist():
                start, length = low + a, b - a + q
                # the same stretch found before has a smaller period that divides q
                if length >= max(min_length, times * q) and (start, length) not in places:
                    places.add((start, length))
                    runs.append((start, length, q))
    return sorted((s, n, p) for s, n, p in runs)


def _runs_of_step(data: np.ndarray, offsets: np.ndarray, min_length: int, times: int):
    """Per row of one step: number of words and runs; and the texts without repeats as bytes and offsets."""
    starts, ends, at = word_bounds(data, offsets)
    codes = word_codes(data, starts, ends)
    found: list[list[tuple[int, int, int]]] = [[] for _ in range(len(offsets) - 1)]
    kept = np.ones(len(starts), bool)
    for a, b in split_segments(codes, at, min_length, times):
        row = int(np.searchsorted(at, a, "right")) - 1
        for s, n, q in lag_scan(codes[a:b], min_length, times):
            found[row].append((a + s - int(at[row]), n, q))
            kept[a + s + q:a + s + n] = False
    for runs in found:
        runs.sort(key=lambda r: (r[0], r[2]))
    # kept words of a row with one space between them
    words = np.flatnonzero(kept)
    row_of = np.searchsorted(at, words, "right")
    joined = np.append(row_of[1:] == row_of[:-1], False) if len(words) else np.zeros(0, bool)
    turn = np.zeros(len(data) + 2, np.int8)
    turn[starts[words]] += 1
    turn[ends[words] + joined] -= 1
    inside = np.cumsum(turn[:len(data)], dtype=np.int8).astype(bool)
    spaced = data.copy()
    spaced[ends[words][joined]] = 0x20
    sizes = np.concatenate([[0], np.cumsum(inside)])
    return np.diff(at), found, spaced[inside], sizes[offsets]


def find_runs(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, min_length: int = 6, times: int = 4) -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` per row of ``df``.

    ``runs`` is an array of ``start, length, period`` (words counted from 0) by
    start, then period; ``collapsed`` has the words that no run holds after its
    first period, one space between them.  A null or empty text, or one of
    white space, has no words, no runs and an empty ``collapsed``.  Every row is
    looked at on its own: rows may repeat, ids may be null or tie, texts may
    have any length, an empty table gives an empty result.  Other columns, of
    any name, are not read.
    """
    if times < 2 or min_length < 1:
        raise ValueError("a run repeats its period, so times is 2 or more and min_length 1 or more")
    rows = df.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    schema = StructType([StructField("doc_id", rows.schema["doc_id"].dataType), StructField("n_words", LongType()),
                         StructField("runs", ArrayType(RUN, False)), StructField("collapsed", StringType())])
    run_type = pa.list_(pa.struct([pa.field(c, pa.int64(), False) for c in RUN.names]))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, data, offsets in text_steps(batch.column("text")):
                n_words, found, kept, ends = _runs_of_step(data, offsets, min_length, times)
                texts = pa.Array.from_buffers(pa.large_binary(), len(found), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(kept)])
                runs = pa.array([[dict(zip(RUN.names, r)) for r in runs] for runs in found], run_type)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(row, len(found)), pa.array(n_words, pa.int64()), runs, texts.cast(pa.binary()).cast(pa.string())],
                    names=schema.names)

    return rows.mapInArrow(scan, schema)


def longest_run(runs: Column) -> Column:
    """The run with the greatest length (ties: smallest start, then period) as a struct; null without runs."""
    best = F.array_max(F.transform(runs, lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    return F.when(F.size(runs) > 0, F.struct((-best["s"]).alias("start"), best["length"].alias("length"), (-best["p"]).alias("period")))


def runs_digest(runs: Column) -> Column:
    """sha256 of ``start,length,period`` and a line feed for every run, in the order of ``runs``."""
    lines = F.transform(runs, lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"),
                                                             r["period"].cast("string")), F.lit("\n")))
    return F.sha2(F.array_join(lines, "").cast("binary"), 256)
