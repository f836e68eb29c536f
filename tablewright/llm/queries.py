"""The operators' registered queries, with production parameters, and their DuckDB SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from tablewright.llm import (
    centroids, chat, fingerprints, html_text, jaccard, langid, licenses, lines, mixing, packing, quality, rules, runs,
)
from tablewright.llm.common import let, table, words_of


def op1_jaccard_join(spark, d):
    return jaccard.jaccard_components(table(spark, d, "documents"))


def op2_chat_format(spark, d):
    return chat.format_chats(table(spark, d, "conversations"))


def op3_line_dedup(spark, d):
    return lines.dedup_lines(table(spark, d, "documents").select("doc_id", "text"))


def op4_quality_classifier(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text")
    model = quality.train_quality(docs, table(spark, d, "labels"))
    return quality.score_quality(docs, model).select("doc_id", quality.held_out("doc_id").alias("held_out"), "score", "predicted")


def op5_source_mix(spark, d):
    mixed = mixing.mix_sources(table(spark, d, "documents"))
    return mixed.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken", "source")


def op6_html_extraction(spark, d):
    return html_text.extract_main_text(table(spark, d, "pages")).select("page_id", "url", "text", "n_chars")


def op7_language_id(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text", "lang")
    model = langid.train_languages(docs)
    return langid.identify_languages(docs.drop("lang"), model).select(
        "doc_id", langid.held_out("doc_id").alias("held_out"), "lang_pred", "score")


def op8_packing(spark, d):
    return packing.pack_documents(table(spark, d, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


def op9_fingerprints(spark, d):
    return fingerprints.fingerprint_documents(table(spark, d, "documents").select("doc_id", "text"), fallback=True)


def op10_quality_rules(spark, d):
    return rules.quality_rules(table(spark, d, "documents").select("doc_id", "text"))


def planted_runs(docs):
    """``doc_id, text`` of op11's contract: every tenth document by crc32 of its id repeats words from one of them on."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.expr("crc32(cast(cast(doc_id AS string) AS binary)) div 10")

    def repeated(w):
        n = F.size(w).cast("long")
        a = g % n
        return let(F.struct(n.alias("n"), a.alias("a"), (F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))).alias("p")), lambda x: F.concat_ws(
            " ", F.slice(w, F.lit(1), x["a"].cast("int")),
            F.transform(F.sequence(x["a"], x["n"] - 1), lambda i: F.get(w, (x["a"] + (i - x["a"]) % x["p"]).cast("int")))))

    edited = let(words_of(F.col("text")), lambda w: F.when(F.size(w) > 0, repeated(w)).otherwise(F.lit("")))
    return docs.select("doc_id", F.when(h % 10 == 0, edited).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark, d):
    found = runs.find_runs(planted_runs(table(spark, d, "documents")))
    best = runs.longest_run(F.col("runs"))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best["start"].alias("start"), best["length"].alias("length"),
        best["period"].alias("period"), F.floor(1000 * best["length"] / best["period"]).alias("exponent_milli"),
        runs.runs_digest(F.col("runs")).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


def op12_license_scan(spark, d):
    found = licenses.scan_licenses(table(spark, d, "documents"))
    base = F.filter("matches", lambda m: m["notice"] < len(licenses.BASE))
    starts = F.transform(base, lambda m: m["first_word"])
    return found.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"), licenses.label_list(base).alias("base_labels"),
        licenses.label_list(F.col("matches")).alias("labels"), licenses.match_score(F.col("matches")).alias("score"))


def op13_centroid_clusters(spark, d):
    return centroids.clustered(centroids.cluster_vectors(table(spark, d, "embeddings")))


QUERIES = {
    "op1_jaccard_join": op1_jaccard_join,
    "op2_chat_format": op2_chat_format,
    "op3_line_dedup": op3_line_dedup,
    "op4_quality_classifier": op4_quality_classifier,
    "op5_source_mix": op5_source_mix,
    "op6_html_extraction": op6_html_extraction,
    "op7_language_id": op7_language_id,
    "op8_packing": op8_packing,
    "op9_fingerprints": op9_fingerprints,
    "op10_quality_rules": op10_quality_rules,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_license_scan": op12_license_scan,
    "op13_centroid_clusters": op13_centroid_clusters,
}

ORACLES = {
    "op1_jaccard_join": jaccard.ORACLE,
    "op2_chat_format": chat.ORACLE,
    "op3_line_dedup": lines.ORACLE,
    "op10_quality_rules": rules.ORACLE,
    "op13_centroid_clusters": centroids.oracle(),
}
