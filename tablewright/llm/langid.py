"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Texts are lower-cased; runs of characters that are no letters become one
blank; n-grams of one to three characters are hashed to ``BUCKETS`` features
weighted by ``(1 + log tf) * idf`` and scaled to unit length.  The model is
trained with follow-the-regularised-leader (per-coordinate steps, L1 and L2
penalties), which leaves most weights exactly zero, and its scores are
calibrated by a temperature fitted on rows that training didn't see.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

BUCKETS = 1 << 14
ORDERS = (1, 2, 3)
STEP_ROWS, STEP_CHARS = 64, 1 << 20
UNKNOWN = "und"
_GAPS = re.compile(r"[\W\d_]+")


def gram_counts(texts: list[str]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Hashed n-grams of runs of texts: number of texts, then row, bucket and count of each n-gram they hold, by row and bucket."""
    row = 0
    while row < len(texts):
        end, chars = row, 0
        while end < len(texts) and end - row < STEP_ROWS and (end == row or chars + len(texts[end]) <= STEP_CHARS):
            chars += len(texts[end])
            end += 1
        some = [" " + _GAPS.sub(" ", t.lower()).strip() + " " for t in texts[row:end]]
        sizes = np.array([len(t) for t in some])
        points = np.frombuffer("".join(some).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
        owner = np.repeat(np.arange(len(some)) * BUCKETS, sizes)
        cells = np.zeros(len(some) * BUCKETS, np.int64)
        key = np.zeros(len(points), np.int64)
        for n in range(1, max(ORDERS) + 1):
            m = len(points) - n + 1
            if m <= 0:
                break
            key = (key[:m] * 1_000_003 + points[n - 1:]) & 0x7FFFFFFFFFFF
            if n in ORDERS:
                whole = owner[:m] == owner[n - 1:]
                bucket = ((key * 0x9E3779B1 + n * 7919) >> 13) % BUCKETS
                cells += np.bincount((owner[:m] + bucket)[whole], minlength=len(cells))
        on = np.flatnonzero(cells)
        yield len(some), on // BUCKETS, on % BUCKETS, cells[on]
        row = end


@dataclass
class LanguageModel:
    languages: list[str]
    idf: np.ndarray         # BUCKETS
    weights: np.ndarray     # BUCKETS x languages
    bias: np.ndarray        # languages
    temperature: float

    def probabilities(self, rows: int, row: np.ndarray, index: np.ndarray, count: np.ndarray) -> np.ndarray:
        """Probability of each language (columns) for each of ``rows`` texts, from the counts of :func:`gram_counts`."""
        value = (1 + np.log(count)) * self.idf[index]
        norm = np.maximum(np.sqrt(np.bincount(row, value * value, rows)), 1e-9)
        z = np.stack([np.bincount(row, value * w[index], rows) / norm for w in self.weights.T], axis=1)
        z = (z + self.bias) / self.temperature
        e = np.exp(z - z.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)


Sparse = list[tuple[np.ndarray, np.ndarray]]  # index and value of each row's non-zeros


def dense(rows: Sparse, columns: np.ndarray | None = None) -> np.ndarray:
    """Rows as a matrix over ``columns`` (sorted; all buckets when None)."""
    out = np.zeros((len(rows), BUCKETS if columns is None else len(columns)))
    for k, (index, value) in enumerate(rows):
        out[k, index if columns is None else np.searchsorted(columns, index)] = value
    return out


def fit_ftrl(rows: Sparse, y: np.ndarray, classes: int, alpha: float = 1.0, beta: float = 1.0, l1: float = 0.002,
             l2: float = 0.001, epochs: int = 6, batch: int = 16, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Weights and bias by FTRL-proximal with an elastic-net penalty (the bias is not penalised)."""
    rng = np.random.default_rng(seed)
    z = np.zeros((BUCKETS + 1, classes))  # the last row is the bias
    n = np.zeros_like(z)
    penalty = np.full((BUCKETS + 1, 1), l1)
    penalty[-1] = 0

    def weights(z: np.ndarray, n: np.ndarray, penalty: np.ndarray) -> np.ndarray:
        shrunk = np.sign(z) * np.maximum(np.abs(z) - penalty, 0)
        return -shrunk / ((beta + np.sqrt(n)) / alpha + l2)

    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for a in range(0, len(rows), batch):
            picks = order[a:a + batch]
            some = [rows[i] for i in picks]
            on = np.unique(np.concatenate([i for i, _ in some]))
            xs = np.hstack([dense(some, on), np.ones((len(picks), 1))])
            on = np.append(on, BUCKETS)
            w = weights(z[on], n[on], penalty[on])
            logits = xs @ w
            p = np.exp(logits - logits.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(picks)), y[picks]] -= 1
            g = xs.T @ p / len(picks)
            root = np.sqrt(n[on])
            n[on] += g * g
            z[on] += g - (np.sqrt(n[on]) - root) / alpha * w
    w = weights(z, n, penalty)
    return w[:-1], w[-1]


def held_out(id_col: str, folds: int = 4, fold: int = 2) -> Column:
    """Rows whose crc32 of the id, as text, leaves the held-out remainder; a null id is held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % folds == fold, F.lit(True))


def _has_letter(text: Column) -> Column:
    return F.coalesce(F.rlike(text, F.lit(r"\p{L}")), F.lit(False))


def _count_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        index, count = [], []
        for rows, row, bucket, found in gram_counts(batch.column(0).to_pylist()):
            ends = np.searchsorted(row, np.arange(1, rows))
            index += np.split(bucket.astype(np.int16), ends)
            count += np.split(found.astype(np.int32), ends)
        yield pa.record_batch([batch.column(1), pa.array(index, pa.list_(pa.int16())), pa.array(count, pa.list_(pa.int32()))],
                              names=["lang", "index", "count"])


def train_languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                    rows_per_language: int = 800, check_share: float = 0.2) -> LanguageModel:
    """Model of the languages of the documents that are not held out.

    Fitted on at most ``rows_per_language`` documents of each language, those
    with the smallest hashes of their ids; ``check_share`` of them only fit the
    temperature.  Rows without language, letters or id don't count; rows that
    repeat an id and language count once, by their smallest text.  Other
    columns are ignored.  Without any row left the model knows ``und`` alone.

    A language is ranked among the ids below a hash bound that lets about
    ``4 * rows_per_language`` of its ids through, whatever their number, so no
    task gets more of a language that most documents are in.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"), F.col(f"`{lang_col}`").alias("lang"))
    rows = rows.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out("id"))
    hashed = rows.select("id", "lang", F.xxhash64(F.col("id").cast("string")).alias("hash"))
    ids = hashed.groupBy("lang").agg(F.approx_count_distinct("id").alias("ids"))  # a row for each language, as the model has
    below = F.col("hash").cast("double") <= F.lit(2.0 ** 64) * F.least(F.lit(1.0), 4.0 * rows_per_language / F.col("ids")) - 2.0 ** 63
    able = hashed.join(F.broadcast(ids), "lang").where(below).select("id", "lang", "hash").distinct()
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("hash", "id"))
    picked = able.withColumn("rank", rank).where(F.col("rank") <= rows_per_language).select("id", "lang")
    sample = (rows.join(F.broadcast(picked), ["id", "lang"]).groupBy("id", "lang").agg(F.min("text").alias("text"))
              .where(_has_letter(F.col("text"))))
    found = sample.select("text", "lang").mapInArrow(_count_rows, "lang string, index array<smallint>, count array<int>").toArrow()
    langs = found.column("lang").to_pylist()
    names = sorted(set(langs))
    if not names:
        return LanguageModel([UNKNOWN], np.zeros(BUCKETS), np.zeros((BUCKETS, 1)), np.zeros(1), 1.0)
    rows = [(lang, i.values.to_numpy(), c.values.to_numpy()) for lang, i, c in
            zip(langs, found.column("index"), found.column("count"))]
    rows.sort(key=lambda r: (r[0], len(r[1]), r[1].tobytes(), r[2].tobytes()))
    y = np.array([names.index(r[0]) for r in rows])
    holding = np.bincount(np.concatenate([r[1] for r in rows]), minlength=BUCKETS)
    model = LanguageModel(names, np.log((1 + len(rows)) / (1 + holding)) + 1, np.zeros((BUCKETS, len(names))), np.zeros(len(names)), 1.0)
    sparse: Sparse = []
    for _, index, count in rows:  # the rows stay sparse: the driver holds their non-zeros only
        value = (1 + np.log(count)) * model.idf[index]
        sparse.append((index.astype(np.int64), value / np.sqrt(value @ value)))
    check = np.random.default_rng(3).random(len(rows)) < check_share
    if check.all() or not check.any():
        check[:] = False
    model.weights, model.bias = fit_ftrl([r for r, c in zip(sparse, check) if not c], y[~check], len(names))
    if check.any():
        seen = [r for r, c in zip(sparse, check) if c]
        logits = np.concatenate([dense(seen[a:a + STEP_ROWS]) @ model.weights + model.bias for a in range(0, len(seen), STEP_ROWS)])

        def loss(t: float) -> float:
            z = logits / t
            z = z - z.max(axis=1, keepdims=True)
            return float((np.log(np.exp(z).sum(axis=1)) - z[np.arange(len(z)), y[check]]).mean())
        model.temperature = float(min(np.geomspace(0.05, 5, 60), key=loss))
    return model


def identify_languages(docs: DataFrame, model: LanguageModel, text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` plus ``lang_pred`` and ``score`` (input columns of those names are replaced).

    A null text or a text without a letter is ``und`` with score 0; languages
    that tie go to the smaller name.  Rows are scored one by one, whatever
    their ids, repeats and other columns; an empty table gives no rows.
    """
    plain = docs.drop("lang_pred", "score")
    at = plain.columns.index(text_col)
    fields = StructType([StructField("row", plain.schema), StructField("lang_pred", StringType()), StructField("score", DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            able = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
            texts = batch.column(0).flatten()[at].filter(pa.array(able)).to_pylist()
            found = np.full(batch.num_rows, UNKNOWN, object)
            score = np.zeros(batch.num_rows)
            rows = np.flatnonzero(able)
            a = 0
            for n, *grams in gram_counts(texts):
                p = model.probabilities(n, *grams)
                best = p.argmax(axis=1)
                here = rows[a:a + n]
                found[here] = [model.languages[b] for b in best]
                score[here] = p[np.arange(n), best]
                a += n
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.tolist(), pa.string()), pa.array(score)],
                                             names=["row", "lang_pred", "score"])

    folded = plain.select(F.struct(*[F.col(f"`{c}`") for c in plain.columns]).alias("row"), _has_letter(F.col(f"`{text_col}`")).alias("able"))
    return folded.mapInArrow(run, fields).select("row.*", "lang_pred", "score")
