"""Every pipeline stage against a brute-force version, each on its own input."""

import random
from collections import Counter

import pytest
from test_llm_sets import brute_components, brute_lines
from test_llm_text import brute_targets, check_packing, words

import corpus_pipeline
from tablewright.llm import quality
from tablewright.llm.common import table

CLASH = {"score": "s", "_th": "t", "grp": "g", "hi": "h", "_kept": "k"}


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """Documents of the small table, with junk, copies, nulls and columns of clashing names."""
    base = "/root/testdata/sf0.001"
    rng = random.Random(3)
    rows = [(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in table(spark, base, "documents").collect()]
    texts = [r[1] for r in rows if r[1] and len(words(r[1])) > 60]
    for k in range(30):
        w = words(rng.choice(texts))
        w[rng.randrange(len(w))] = "changed"
        rows.append((10_000 + k, " ".join(w), None, rng.choice([None, "src0"]), 1))
    rows += [(20_000, None, "en", "src0", None), (20_001, "", "en", "x", 0), (20_002, "word " * 9000, "en", "src0", 45_000)]
    path = str(tmp_path_factory.mktemp("corpus"))
    docs = spark.createDataFrame([(*r, *CLASH.values()) for r in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASH))
    docs.write.parquet(f"{path}/documents.parquet")
    table(spark, base, "labels").write.parquet(f"{path}/labels.parquet")
    return path


def pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_stages(spark, corpus):
    docs = table(spark, corpus, "documents")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, corpus)
        if name != "packing":
            assert out.schema.names == docs.schema.names and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
            out = spark.createDataFrame(out.collect(), out.schema)
            assert all(r.score == "s" and r.hi == "h" and (r.text is None or r.n_chars == len(r.text) or name != "line_dedup")
                       for r in out.collect())
        seen[name] = (docs, out)
        docs = out

    before, after = map(pairs, seen["quality_classifier"])
    model = quality.train_quality(table(spark, corpus, "documents").select("doc_id", "text"), table(spark, corpus, "labels"))
    scored = quality.score_quality(seen["quality_classifier"][0].select("doc_id", "text"), model).collect()
    assert Counter(after) == Counter((r.doc_id, r.text) for r in scored if r.score >= 0.3)

    before, after = map(pairs, seen["line_dedup"])
    assert sorted(after) == [r[:2] for r in brute_lines(before)]

    before, after = map(pairs, seen["jaccard_join"])
    groups = brute_components(before)
    assert sorted(i for i, _ in after) == sorted({c for _, n, c in groups if n} | {i for i, n, _ in groups if not n})

    before, after = seen["source_mix"]
    sizes, taken = Counter(), Counter()
    for r in before.collect():
        sizes[r.source] += len(words(r.text))
    for r in after.collect():
        taken[r.source] += len(words(r.text))
    for s, want in brute_targets(dict(sizes)).items():
        assert abs(taken[s] - want) <= max(1, 2 * min(64, sizes[s] / 256))
    original = dict(pairs(before))
    for i, t in pairs(after):
        assert not Counter(words(t)) - Counter(words(original[i]))

    before, after = seen["packing"]
    check_packing(after.collect(), pairs(before))


def test_run_gives_the_last_stage(spark, corpus):
    out = corpus_pipeline.run(spark, corpus)
    assert out.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert out.count() > 0
    empty = table(spark, corpus, "documents").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, corpus)
        assert empty.collect() == []
