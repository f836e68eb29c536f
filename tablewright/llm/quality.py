"""Quality classifier: a factorisation machine over hashed words, structure and length.

A document is a sparse vector: hashed word counts (log-scaled, unit length),
shares that describe its structure (capitals, symbols, repeated words, ...)
and one-hot length classes.  The model scores ``w0 + sum w_i x_i`` plus all
pairwise interactions ``<v_i, v_j> x_i x_j``; with the identity
``sum_{i<j} <v_i, v_j> x_i x_j = 1/2 sum_f ((sum_i v_if x_i)^2 - sum_i (v_if x_i)^2)``
that takes time linear in the non-zeros.

It is fitted on a bounded, hash-chosen sample of labelled rows (``fit_rows``)
on the driver; every document is scored by the executors over its whole text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from tablewright.llm.vectors import U64, text_steps, word_hashes

WORD_BUCKETS = 1 << 13
SHARES = ("capitals", "symbols", "exclamations", "bars", "digits", "letterless", "repeated", "distinct", "word_length",
          "short_lines", "stops", "bias")
LENGTHS = 16  # classes of log2(number of words)
FEATURES = WORD_BUCKETS + len(SHARES) + LENGTHS


@dataclass
class Machine:
    """Weights of a factorisation machine."""

    w0: float
    w: np.ndarray  # FEATURES
    v: np.ndarray  # FEATURES x factors

    def margins(self, row: np.ndarray, index: np.ndarray, value: np.ndarray, rows: int) -> np.ndarray:
        """Scores before the logistic function; entries are sorted by row and every row has one."""
        at = np.searchsorted(row, np.arange(rows))
        linear = np.add.reduceat(self.w[index] * value, at)
        vx = self.v[index] * value[:, None]
        total, square = np.add.reduceat(vx, at), np.add.reduceat(vx * vx, at)
        return self.w0 + linear + 0.5 * (total * total - square).sum(axis=1)


def _classes() -> dict[str, np.ndarray]:
    """Byte classes; in Latin letters of two bytes the second byte tells the case."""
    def marks(chars: str) -> np.ndarray:
        out = np.zeros(256, bool)
        out[[ord(c) for c in chars]] = True
        return out
    upper, letter = np.zeros(256, bool), np.zeros(256, bool)
    upper[65:91] = letter[65:91] = letter[97:123] = letter[0xC3:0xF5] = True
    return {"upper": upper, "letter": letter, "symbol": marks("#*$%&|<>@~^{}[]\\"), "!": marks("!"), "|": marks("|"),
            "digit": marks("0123456789"), "stop": marks(".,;:?"), "line": marks("\n")}


_CLASS = _classes()


def features(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """``(first row, rows, row, feature, value)`` of runs of rows, sorted by row."""
    for first, data, offsets in text_steps(column):
        rows = len(offsets) - 1
        words, at = word_hashes(data, offsets)
        n = np.diff(at)
        owner = np.repeat(np.arange(rows), n)

        def per_row(mask: np.ndarray) -> np.ndarray:
            total = np.concatenate([[0], np.cumsum(mask)])
            return (total[offsets[1:]] - total[offsets[:-1]]).astype(float)

        key, count = np.unique(owner * WORD_BUCKETS + (words % U64(WORD_BUCKETS)).astype(np.int64), return_counts=True)
        row, bucket = key // WORD_BUCKETS, key % WORD_BUCKETS
        value = 1 + np.log(count)
        norm = np.sqrt(np.bincount(row, value * value, rows))
        value = value / np.maximum(norm[row], 1e-9)

        m = np.maximum(n, 1).astype(float)
        letter = _CLASS["letter"][data]
        upper = _CLASS["upper"][data]
        if len(data):
            upper[:-1] |= (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E)
        letters = per_row(letter)
        lines = per_row(_CLASS["line"][data]) + 1
        same = np.zeros(len(words), bool)
        same[1:] = (words[1:] == words[:-1]) & (owner[1:] == owner[:-1])
        starts, ends = word_letters(data, offsets, letter)
        shares = np.stack([
            per_row(upper) / np.maximum(letters, 1), per_row(_CLASS["symbol"][data]) / m, per_row(_CLASS["!"][data]) / m,
            per_row(_CLASS["|"][data]) / m, per_row(_CLASS["digit"][data]) / m, (starts - ends) / m,
            np.bincount(owner, same, rows) / m, np.bincount(row, minlength=rows) / m,
            letters / m / 10, np.minimum(lines / m * 5, 1), per_row(_CLASS["stop"][data]) / m, np.ones(rows)], axis=1)
        shares = np.minimum(shares, 2.0)
        length = np.minimum(np.log2(m + 1).astype(int), LENGTHS - 1)
        k = len(SHARES)
        row = np.concatenate([row, np.repeat(np.arange(rows), k), np.arange(rows)])
        feature = np.concatenate([bucket, np.tile(WORD_BUCKETS + np.arange(k), rows), WORD_BUCKETS + k + length])
        value = np.concatenate([value, shares.ravel(), np.ones(rows)])
        order = np.argsort(row, kind="stable")
        yield first, rows, row[order], feature[order], value[order]


def word_letters(data: np.ndarray, offsets: np.ndarray, letter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words per row, and words per row that have a letter."""
    rows = len(offsets) - 1
    space = np.zeros(256, bool)
    space[[0x20, *range(0x09, 0x0E)]] = True
    gap = space[data]
    starts = ~gap
    starts[1:] &= gap[:-1]
    inner = offsets[(offsets > 0) & (offsets < len(data))]
    starts[inner] = ~gap[inner]
    at = np.flatnonzero(starts)
    if not len(at):
        return np.zeros(rows), np.zeros(rows)
    has = np.add.reduceat(letter.astype(np.int32), at) > 0
    owner = np.searchsorted(offsets, at, "right") - 1
    return np.bincount(owner, minlength=rows)[:rows], np.bincount(owner, has, rows)[:rows]


def fit_machine(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, factors: int = 8, epochs: int = 12,
                rate: float = 0.1, l2: float = 1e-5, batch: int = 64, seed: int = 7) -> Machine:
    """Logistic loss, AdaGrad steps over shuffled batches."""
    rng = np.random.default_rng(seed)
    size = FEATURES
    model = Machine(0.0, np.zeros(size), rng.normal(0, 0.01, (size, factors)))
    if not len(rows) or labels.min() == labels.max():
        model.w0 = 0.0 if not len(rows) else (4.0 if labels[0] else -4.0)
        return model
    g0, gw, gv = 1e-8, np.full(size, 1e-8), np.full((size, factors), 1e-8)
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for a in range(0, len(rows), batch):
            picks = order[a:a + batch]
            n = [len(rows[i][0]) for i in picks]
            row = np.repeat(np.arange(len(picks)), n)
            index = np.concatenate([rows[i][0] for i in picks])
            value = np.concatenate([rows[i][1] for i in picks]).astype(float)
            margin = model.margins(row, index, value, len(picks))
            slope = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - labels[picks]) / len(picks)
            at = np.searchsorted(row, np.arange(len(picks)))
            total = np.add.reduceat(model.v[index] * value[:, None], at)
            s = slope[row] * value
            uniq, back = np.unique(index, return_inverse=True)
            dw = np.bincount(back, s, len(uniq)) + l2 * model.w[uniq]
            part = s[:, None] * (total[row] - model.v[index] * value[:, None])
            dv = np.stack([np.bincount(back, part[:, f], len(uniq)) for f in range(factors)], axis=1) + l2 * model.v[uniq]
            g0 += slope.sum() ** 2
            model.w0 -= rate * slope.sum() / np.sqrt(g0)
            gw[uniq] += dw * dw
            model.w[uniq] -= rate * dw / np.sqrt(gw[uniq])
            gv[uniq] += dv * dv
            model.v[uniq] -= rate * dv / np.sqrt(gv[uniq])
    return model


def held_out(id_col: str, folds: int = 5) -> Column:
    """Rows whose crc32 of the id, as text, leaves no remainder; a null id is held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % folds == 0, F.lit(True))


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        index, value = [], []
        for _, rows, row, feature, v in features(batch.column(0)):
            cuts = np.searchsorted(row, np.arange(1, rows))
            index += [x.astype(np.int32) for x in np.split(feature, cuts)]
            value += [x.astype(np.float32) for x in np.split(v, cuts)]
        yield pa.record_batch([batch.column(1), pa.array(index, pa.list_(pa.int32())), pa.array(value, pa.list_(pa.float32()))],
                              names=["quality", "index", "value"])


def train_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", fit_rows: int = 5000,
                  **options) -> Machine:
    """Machine fitted on at most ``fit_rows`` labelled documents that are not held out.

    The rows are those with the smallest hashes of their ids among all
    labelled ids; unlabelled rows and rows without text don't count.
    """
    picked = (labels.where(F.col("quality").isin(0, 1) & ~held_out(id_col)).groupBy(id_col).agg(F.max("quality").alias("quality"))
              .orderBy(F.xxhash64(F.col(id_col).cast("string")), id_col).limit(fit_rows)
              .select(F.col(id_col).alias("_id"), "quality"))
    sample = docs.join(F.broadcast(picked), F.col(id_col) == F.col("_id")).where(F.col(text_col).isNotNull())
    found = sample.select(text_col, "quality").mapInArrow(
        _feature_rows, "quality int, index array<int>, value array<float>").toArrow()
    rows = list(zip((x.values.to_numpy() for x in found.column("index")), (x.values.to_numpy() for x in found.column("value"))))
    order = sorted(range(len(rows)), key=lambda i: (len(rows[i][0]), rows[i][0].tobytes(), rows[i][1].tobytes()))
    return fit_machine([rows[i] for i in order], found.column("quality").to_numpy()[order].astype(float), **options)


def score_quality(docs: DataFrame, model: Machine, id_col: str = "doc_id", text_col: str = "text",
                  accept: float = 0.3, names: tuple[str, str] = ("score", "predicted")) -> DataFrame:
    """All columns of ``docs`` plus score and prediction, named by ``names`` (input columns of those names are replaced).

    Null and empty texts are scored by their length class alone.
    """
    docs = docs.drop(*names)
    fields = StructType([*docs.schema.fields, StructField(names[0], DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = np.zeros(batch.num_rows)
            for first, rows, row, feature, value in features(batch.column(batch.schema.get_field_index(text_col))):
                margin = model.margins(row, feature, value, rows)
                score[first:first + rows] = 1 / (1 + np.exp(-np.clip(margin, -30, 30)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score)], names=[*batch.schema.names, names[0]])

    return docs.mapInArrow(run, fields).withColumn(names[1], (F.col(names[0]) >= accept).cast("int"))
