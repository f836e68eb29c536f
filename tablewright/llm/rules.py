"""Quality rules as a short-circuit cascade.

Every rule is a native column that is true when a document fails it.  Each
rule's cost (seconds) and rejection rate are measured on a bounded sample;
the cascade then tests the rules in descending order of rejection per cost in
one CASE expression, so a document pays only for the rules up to the first it
fails.  The order changes the work, never the verdict.
"""

from __future__ import annotations

import math
import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import let, parquet_table, words_of

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def left_after(text: Column, gone: str) -> Column:
    """Number of characters left when every run of ``gone`` is deleted."""
    return F.length(F.regexp_replace(text, gone, ""))


def window_hashes(w: Column) -> Column:
    """Hashes of the 3-word windows."""
    def hashes(v: Column) -> Column:
        every = F.transform(v, lambda x, i: F.xxhash64(x, F.get(v, i + 1), F.get(v, i + 2)))
        return F.slice(every, F.lit(1), F.greatest(F.size(v) - 2, F.lit(0)))
    return let(w, hashes)


def repeated_words(h: Column) -> Column:
    """Words inside windows whose hash occurs twice or more, first occurrences included."""
    def covered(s: Column) -> Column:
        def twin(x: Column, j: Column) -> Column:
            return ((F.get(s, j + 1)["h"] == x["h"]) | ((j > 0) & (F.get(s, F.greatest(j - 1, F.lit(0)))["h"] == x["h"])))
        starts = F.transform(F.filter(s, lambda x, j: F.coalesce(twin(x, j), F.lit(False))), lambda x: x["i"])
        return F.size(F.array_distinct(F.flatten(F.transform(starts, lambda i: F.array(i, i + 1, i + 2)))))

    placed = F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))
    return F.when(F.size(F.array_distinct(h)) == F.size(h), 0).otherwise(let(F.sort_array(placed), covered))


def with_counts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id_col``, the counts, and the working columns ``_text``, ``_w``, ``_lines``, ``_joined`` (the words without gaps)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = docs.select(F.col(id_col), text.alias("_text"), words_of(text).alias("_w"))
    lines = F.filter(F.split("_text", "\n"), lambda x: F.rlike(x, F.lit(r"[^\x20\x09-\x0D]")))
    base = base.select("*", lines.alias("_lines"), F.array_join("_w", "").alias("_joined"), window_hashes(F.col("_w")).alias("_h"))
    return base.select(
        id_col, "_text", "_w", "_lines", "_joined",
        F.size("_w").cast("long").alias("n_words"),
        F.length("_joined").cast("long").alias("word_chars"),
        F.regexp_count("_joined", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("_h")).cast("long").alias("n_repeat_words"))


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


@dataclass(frozen=True)
class Rule:
    name: str
    fails: Callable[[], Column]  # over the columns of with_counts


def _stutter() -> Column:
    """More than a tenth of the words equal the word before them."""
    def again(w: Column) -> Column:
        return F.size(F.filter(w, lambda x, i: F.coalesce(x == F.get(w, i - 1), F.lit(False))))
    return 10 * let(F.col("_w"), again) > F.size("_w")


def _shouting() -> Column:
    """More than three tenths of the letters are capitals."""
    capitals = left_after(F.col("_joined"), r"[^\p{Lu}]+")
    letters = F.length("_joined") - left_after(F.col("_joined"), r"\p{L}+")
    return 10 * capitals > 3 * letters


def _letterless() -> Column:
    """More than a fifth of the words have no letter."""
    with_letter = F.regexp_count("_text", F.lit(r"\p{L}[^\x20\x09-\x0D]*"))
    return 5 * (F.col("n_words") - with_letter) > F.col("n_words")


DEFAULT_RULES = (
    Rule("symbols", lambda: 10 * F.col("n_symbols") > F.col("n_words")),
    Rule("word_length", lambda: (F.col("word_chars") < 2 * F.col("n_words")) | (F.col("word_chars") > 12 * F.col("n_words"))),
    Rule("duplicate_lines", lambda: 2 * F.col("n_dup_lines") > F.size("_lines")),
    Rule("exclamation", lambda: 5 * F.regexp_count("_joined", F.lit("!")) > F.col("n_words")),
    Rule("digits", lambda: 5 * F.regexp_count("_joined", F.lit("[0-9]")) > F.col("word_chars")),
    Rule("shouting", _shouting),
    Rule("letterless_words", _letterless),
    Rule("stutter", _stutter),
    Rule("bullets", lambda: 10 * F.size(F.filter("_lines", lambda x: F.rlike(x, F.lit("^[ \t]*[-*•]")))) > 9 * F.size("_lines")),
    Rule("ellipses", lambda: 10 * F.size(F.filter("_lines", lambda x: F.rlike(x, F.lit(r"(\.\.\.|…)[ \t]*$")))) > 3 * F.size("_lines")),
)


@dataclass(frozen=True)
class Measured:
    """``rejects``: share of the rows that the rules before it keep; ``seconds``: cost of the rule alone on the sample."""

    rule: Rule
    rejects: float
    seconds: float

    @property
    def gain(self) -> float:
        return self.rejects / self.seconds


def order_rules(rules: list[Rule], seconds: list[float], fails: list[list[bool]]) -> list[Measured]:
    """Best gain first, each rule's rejection taken among the rows that those before it keep; ``fails``: a list for each row."""
    left, rows, out = list(range(len(rules))), fails, []
    while left:
        share = {r: sum(f[r] for f in rows) / len(rows) if rows else 0.0 for r in left}
        best = min(left, key=lambda r: (-share[r] / seconds[r], seconds[r], rules[r].name))
        out.append(Measured(rules[best], share[best], seconds[best]))
        left.remove(best)
        rows = [f for f in rows if not f[best]]
    return out


def measure_rules(docs: DataFrame, id_col: str, text_col: str, rules: tuple[Rule, ...] = DEFAULT_RULES,
                  sample_rows: int = 256, repeats: int = 8) -> list[Measured]:
    """Rejection and cost of each rule on about ``sample_rows`` rows, in the order of the cascade.

    The sample is by hash of the id and the text's start; documents that the
    base rule rejects don't count.  It stays in a table; the driver gets a
    flag for each row and rule.  A rule's cost is the quicker of two jobs over
    the sample, repeated, less that of a job with an empty rule.
    """
    one_of = max(1, docs.count() // sample_rows)
    picked = docs.select(F.col(f"`{id_col}`").alias("_row"), F.col(f"`{text_col}`").alias("_sampled")).where(
        F.pmod(F.xxhash64("_row", F.substring("_sampled", 1, 64)), F.lit(one_of)) == 0)
    # stored before it is counted, so that no other row's words are; then again, so that the counts are made once a row
    picked = parquet_table(picked, "rule-rows")
    counted = parquet_table(with_counts(picked, "_row", "_sampled").where(~base_failed()).limit(4 * sample_rows).coalesce(1), "rule-sample")
    flags = [F.coalesce(r.fails(), F.lit(False)) for r in rules]
    fails = [list(r) for r in counted.select(*[f.alias(f"f{i}") for i, f in enumerate(flags)]).collect()]
    again = counted.withColumn("_again", F.explode(F.sequence(F.lit(1), F.lit(repeats))))

    def cost(flag: Column) -> float:
        best = math.inf
        for _ in range(2):
            began = time.perf_counter()
            again.agg(F.count_if(flag)).first()
            best = min(best, time.perf_counter() - began)
        return best

    cost(F.lit(False))  # starts the readers, so that no job pays for it
    empty = cost(F.col("n_words") < 0)
    return order_rules(list(rules), [max(cost(f) - empty, 1e-3) for f in flags], fails)


def cascade(rules: list[Rule]) -> Column:
    """True when no rule fails, testing them in the given order."""
    verdict = F.when(base_failed(), False)
    for r in rules:
        verdict = verdict.when(F.coalesce(r.fails(), F.lit(False)), False)
    return verdict.otherwise(True)


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  rules: tuple[Rule, ...] = DEFAULT_RULES, sample_rows: int = 256) -> DataFrame:
    """``id_col``, the five counts, ``base_failed`` and ``kept`` for every row of ``docs``.

    Null and empty texts have no words and fail; rows that repeat are judged
    one by one; other columns are ignored; an empty table gives no rows.
    """
    order = [m.rule for m in measure_rules(docs, id_col, text_col, rules, sample_rows)]
    return with_counts(docs, id_col, text_col).select(id_col, *COUNTS, base_failed().alias("base_failed"),
                                                      cascade(order).alias("kept"))


ORACLE = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (
  SELECT doc_id, text, list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM d
), g AS (
  SELECT doc_id, i, list_slice(w, i, i + 2) AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM w)
), r AS (
  SELECT doc_id, count(DISTINCT i + k) AS n FROM (
    SELECT doc_id, i, unnest([0, 1, 2]) AS k FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM g)
    WHERE c > 1) GROUP BY doc_id
), c AS (
  SELECT w.doc_id, text, w, l, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words
  FROM w LEFT JOIN r ON r.doc_id = w.doc_id
), b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM c)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 10 * n_symbols > n_words OR word_chars < 2 * n_words OR word_chars > 12 * n_words
            OR 2 * n_dup_lines > len(l)
            OR 5 * length(regexp_replace(text, '[^!]', '', 'g')) > n_words
            OR 5 * length(regexp_replace(text, '[^0-9]', '', 'g')) > word_chars
            OR 10 * length(regexp_replace(text, '[^\p{Lu}]', '', 'g')) > 3 * length(regexp_replace(text, '[^\p{L}]', '', 'g'))
            OR 5 * len(list_filter(w, lambda x: NOT regexp_matches(x, '\p{L}'))) > n_words
            OR 10 * len(list_filter(range(2, len(w) + 1), lambda i: w[i] = w[i - 1])) > n_words
            OR 10 * len(list_filter(l, lambda x: regexp_matches(x, '^[ \t]*[-*•]'))) > 9 * len(l)
            OR 10 * len(list_filter(l, lambda x: regexp_matches(x, '(\.\.\.|…)[ \t]*$'))) > 3 * len(l)) AS kept
FROM b
"""
