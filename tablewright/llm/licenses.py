"""License scan: fuzzy search for short notices.

Words are runs of digits, a-z (A-Z lowered) and characters beyond ASCII; a text
is searched as its words with one space between them.  A notice with a bound
of ``k`` edits is cut into ``k + 1`` pieces: ``k`` edits leave one of them
unchanged (pigeonhole), so every occurrence holds an exact piece.  One
automaton finds all pieces of all notices in one pass over the text; around
each hit stands a window that any occurrence with that piece lies in;
overlapping windows of a notice are joined, and the ``regex`` library's
bounded-error matching verifies them and reports span and edits.  A phrase
with bound 0 is its own piece and must stand between word boundaries, as every
match must.

Texts are searched whole, row by row in Arrow batches: no shuffle, nothing
sampled, and a window is linear in the notice.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType


class Notice(NamedTuple):
    """``phrase``: words with one space between them; ``edits``: characters inserted, deleted or replaced at most."""

    label: str
    phrase: str
    edits: int = 0


# Fixed values of the contract: phrases that name a license by themselves.
BASE = (
    Notice("gpl", "gnu general public license"),
    Notice("apache", "apache license"),
    Notice("cc-by", "cc by"),
    Notice("mit", "mit license"),
)

# Short notices in the wording of public licenses; an edit for each ten characters, roughly.
NOTICES = (
    Notice("gpl", "licensed under the gnu general public license", 4),
    Notice("gpl", "under the terms of the gnu general public license as published by the free software foundation", 9),
    Notice("lgpl", "gnu lesser general public license", 3),
    Notice("agpl", "gnu affero general public license", 3),
    Notice("apache", "licensed under the apache license version 2 0", 4),
    Notice("mit", "released under the mit license", 3),
    Notice("mit", "licensed under the mit license", 3),
    Notice("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", 9),
    Notice("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", 9),
    Notice("bsd", "redistribution and use in source and binary forms with or without modification are permitted", 9),
    Notice("mpl", "subject to the terms of the mozilla public license", 5),
    Notice("epl", "made available under the terms of the eclipse public license", 6),
    Notice("cc-by", "licensed under a creative commons attribution", 4),
    Notice("cc-by", "licensed under cc by", 2),
    Notice("cc-by-nc", "licensed under cc by nc", 2),
    Notice("cc-by-sa", "licensed under cc by sa", 2),
    Notice("cc0", "dedicated to the public domain under cc0", 4),
    Notice("unlicense", "this is free and unencumbered software released into the public domain", 7),
)

_WORD = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


def normal_text(text: str | None) -> tuple[str, int]:
    """The words of ``text`` with one space before, between and after them, and their number."""
    words = (text or "").encode("utf-8").translate(_WORD).split()
    return " " + b" ".join(words).decode("utf-8") + " ", len(words)


def pieces(notice: Notice) -> list[tuple[int, str]]:
    """``edits + 1`` consecutive pieces of the phrase (with its outer spaces when it must be exact) and where they start."""
    n, size = notice.edits + 1, len(notice.phrase)
    if n == 1:
        return [(-1, f" {notice.phrase} ")]
    cuts = [i * size // n for i in range(n + 1)]
    if cuts[1] == 0:
        raise ValueError(f"{notice.phrase!r} is too short for {notice.edits} edits")
    return [(a, notice.phrase[a:b]) for a, b in zip(cuts, cuts[1:])]


class Searcher:
    """Automaton of all pieces and a bounded-error pattern for each notice."""

    def __init__(self, notices: Sequence[Notice]) -> None:
        import ahocorasick
        import regex

        self.notices = list(notices)
        held: dict[str, list[tuple[int, int]]] = {}
        for i, notice in enumerate(self.notices):
            for at, piece in pieces(notice):
                held.setdefault(piece, []).append((i, at))
        self.automaton = ahocorasick.Automaton()
        for piece, owners in held.items():
            self.automaton.add_word(piece, (len(piece), owners))
        if held:
            self.automaton.make_automaton()
        self.patterns = [regex.compile(rf"(?e)(?<= )(?:{regex.escape(n.phrase, literal_spaces=True)}){{e<={n.edits}}}(?= )") for n in self.notices]

    def windows(self, text: str) -> dict[int, list[list[int]]]:
        """Joined windows ``[start, end)`` of ``text`` per notice that a match can lie in, boundary spaces included."""
        found: dict[int, list[list[int]]] = {}
        if not len(self.automaton):
            return found
        for last, (size, owners) in self.automaton.iter(text):
            for i, at in owners:
                notice = self.notices[i]
                low = max(0, last + 1 - size - at - notice.edits - 1)
                high = min(len(text), last + 1 - size - at + len(notice.phrase) + notice.edits + 1)
                found.setdefault(i, []).append([low, high])
        for i, spans in found.items():
            spans.sort()
            joined = [spans[0]]
            for low, high in spans[1:]:
                if low <= joined[-1][1]:
                    joined[-1][1] = max(joined[-1][1], high)
                else:
                    joined.append([low, high])
            found[i] = joined
        return found

    def search(self, text: str) -> list[tuple[int, int, int, int]]:
        """``(notice, first word, words, edits)`` of every verified match, by first word, then notice."""
        found, breaks = [], None
        for i, spans in self.windows(text).items():
            for low, high in spans:
                for m in self.patterns[i].finditer(text, pos=low, endpos=high):
                    if breaks is None:
                        breaks = np.flatnonzero(np.frombuffer(text.encode("utf-32-le"), "<u4") == 32)
                    a, b = np.searchsorted(breaks, [m.start(), m.end()])
                    found.append((i, int(a) - 1, int(b) - int(a) + 1, sum(m.fuzzy_counts)))
        return sorted(found, key=lambda f: (f[1], f[0]))


_SEARCHERS: dict[tuple[Notice, ...], Searcher] = {}


def searcher(notices: Sequence[Notice]) -> Searcher:
    """One searcher per worker and list of notices."""
    key = tuple(Notice(*n) for n in notices)
    if key not in _SEARCHERS:
        _SEARCHERS[key] = Searcher(key)
    return _SEARCHERS[key]


MATCH = StructType([StructField("label", StringType()), StructField("notice", IntegerType()), StructField("first_word", LongType()),
                    StructField("n_words", LongType()), StructField("edits", IntegerType()), StructField("bound", IntegerType())])


def scan_licenses(df: DataFrame, notices: Sequence[Notice] = BASE + NOTICES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, matches`` per row of ``df``.

    ``matches`` holds ``label, notice`` (index in ``notices``), ``first_word``
    (words from 0), ``n_words`` covered, ``edits`` used and their ``bound``, by
    first word, then notice.  Matches of one notice don't overlap each other;
    those of different notices may.  A null or empty text has no words and no
    matches; rows may repeat, ids may be null or tie, texts may have any length;
    an empty table gives an empty result; other columns are not read.
    """
    notices = tuple(Notice(*n) for n in notices)
    rows = df.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    schema = StructType([StructField("doc_id", rows.schema["doc_id"].dataType), StructField("n_words", LongType()),
                         StructField("matches", ArrayType(MATCH))])
    kind = pa.list_(pa.struct([("label", pa.string()), ("notice", pa.int32()), ("first_word", pa.int64()),
                               ("n_words", pa.int64()), ("edits", pa.int32()), ("bound", pa.int32())]))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = searcher(notices)
        for batch in batches:
            counts, found = [], []
            for text in batch.column("text"):
                normal, n = normal_text(text.as_py())
                counts.append(n)
                found.append([{"label": notices[i].label, "notice": i, "first_word": a, "n_words": w, "edits": e, "bound": notices[i].edits}
                              for i, a, w, e in search.search(normal)])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(found, kind)], names=schema.names)

    return rows.mapInArrow(scan, schema)


def label_list(matches: Column) -> Column:
    """Distinct labels of ``matches``, sorted, with commas between them."""
    return F.array_join(F.array_sort(F.array_distinct(F.transform(matches, lambda m: m["label"]))), ",")


def match_score(matches: Column) -> Column:
    """0 without matches, else that of the best one: 1 for an exact match, less by each edit used of those allowed."""
    scores = F.transform(matches, lambda m: F.lit(1.0) - m["edits"] / (m["bound"] + F.lit(1.0)))
    return F.coalesce(F.array_max(scores), F.lit(0.0))
