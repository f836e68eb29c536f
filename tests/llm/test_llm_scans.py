"""Periodic runs, license scan and centroid clustering against brute force."""

import hashlib
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tablewright.llm import centroids, licenses, queries, runs

SPACE = re.compile(r"[\x20\x09-\x0D]+")
CLASHING = "doc_id long, text string, runs string, collapsed string, n_words string, matches string"


def words(text):
    return [w for w in SPACE.split(text or "") if w]


# ------------------------------------------------------------- periodic runs
def brute_runs(w, min_length=6, times=4):
    """Every longest stretch of each period, whose smallest period it is."""
    found = []
    for q in range(1, len(w) // times + 1):
        i = 0
        while i + q < len(w):
            if w[i] != w[i + q]:
                i += 1
                continue
            end = i
            while end + q < len(w) and w[end] == w[end + q]:
                end += 1
            length = end + q - i
            smallest = next(p for p in range(1, q + 1) if all(w[k] == w[k + p] for k in range(i, i + length - p)))
            if length >= max(min_length, times * q) and smallest == q:
                found.append((i, length, q))
            i = end + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def brute_collapsed(w, found):
    gone = {k for s, n, q in found for k in range(s + q, s + n)}
    return " ".join(x for k, x in enumerate(w) if k not in gone)


def run_texts():
    rng = random.Random(11)
    texts = [None, "", " \n\t ", "a", "a a a a a", "a a a a a a", "a b a b a b a b", "a b a b a b a", "É é x " * 5, "x" * 5000, "la " * 3000]
    for _ in range(60):  # few words, so that chance runs are many
        w = [rng.choice("abc") for _ in range(rng.randrange(1, 120))]
        at, period = rng.randrange(len(w) + 1), [rng.choice("abcd") for _ in range(rng.randrange(1, 9))]
        w[at:at] = (period * 9)[:rng.randrange(len(period) * 9)]
        texts.append(rng.choice([" ", "\n", "  \t"]).join(w))
    inner = ["p q"] * 4 + ["z"]  # runs within the period of another run
    texts += [" ".join(inner * 5), " ".join(["a"] * 6 + ["b"] * 6) + " " + " ".join((["a"] * 6 + ["b"] * 6) * 4)]
    prose = [f"w{rng.randrange(400)}" for _ in range(3000)]
    texts += [" ".join(prose), " ".join(prose[:700] * 5), texts[7], texts[7]]
    return texts


def test_runs_match_brute_force(spark):
    docs = list(enumerate(run_texts()))
    df = spark.createDataFrame([(i, t, "r", "c", "n", "m") for i, t in docs] + [(None, "a b " * 9, *"rcnm"), (3, "x " * 7, *"rcnm")], CLASHING)
    got = {(r.doc_id, r.n_words, tuple(map(tuple, r.runs)), r.collapsed) for r in runs.find_runs(df).collect()}
    want = set()
    for i, t in [*docs, (None, "a b " * 9), (3, "x " * 7)]:
        w = words(t)
        found = brute_runs(w)
        want.add((i, len(w), tuple(found), brute_collapsed(w, found)))
    assert got == want
    assert runs.find_runs(df.limit(0)).collect() == []
    with pytest.raises(ValueError):
        runs.find_runs(df, times=1)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=60), st.integers(1, 8), st.integers(2, 5))
def test_splitting_and_lag_scan_lose_no_run(w, min_length, times):
    codes = np.array(w, np.int64)
    found = [(a + s, n, q) for a, b in runs.split_segments(codes, np.array([0, len(w)]), min_length, times)
             for s, n, q in runs.lag_scan(codes[a:b], min_length, times)]
    assert sorted(found) == sorted(brute_runs(w, min_length, times))


def test_scan_is_not_quadratic_in_a_long_run():
    w = np.zeros(200_000, np.int64)
    assert runs.lag_scan(w, 6, 4) == [(0, 200_000, 1)]
    w[1::2] = 1
    assert runs.lag_scan(w, 6, 4) == [(0, 200_000, 2)]


def contract_row(doc_id, text):
    w, h = words(text), zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and w:
        a = g % len(w)
        p = 1 + (len(w) - a) // (3 + g % 8)
        w = w[:a] + [w[a + (i - a) % p] for i in range(a, len(w))]
    found = brute_runs(w)
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    digest = "".join(f"{s},{n},{q}\n" for s, n, q in found)
    return (doc_id, len(found), *best, 1000 * best[1] // best[2] if found else None, hashlib.sha256(digest.encode()).hexdigest(),
            hashlib.sha256(brute_collapsed(w, found).encode()).hexdigest())


def test_run_query_follows_the_contract(spark, tmp_path):
    rng = random.Random(2)
    docs = [(i, " ".join(rng.choice(["a", "b", "c", "dé"]) for _ in range(rng.randrange(0, 90)))) for i in range(200)] + [(900, None), (901, "")]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {tuple(r) for r in queries.op11_periodic_runs(spark, str(tmp_path)).collect()}
    assert got == {contract_row(*d) for d in docs}
    assert any(zlib.crc32(str(i).encode()) % 10 == 0 and t for i, t in docs)


# ------------------------------------------------------------- licenses
def least_edits(phrase, text):
    """Least edit distance between ``phrase`` and a part of ``text`` with a space on both sides."""
    n, best = len(phrase), None
    far = 10**6
    row = [far] * (n + 1)
    for at, c in enumerate(text):
        # row[i]: least cost of phrase[:i] ending before text[at]; a match starts after a space
        fresh = at > 0 and text[at - 1] == " "
        start = 0 if fresh else far
        before = [min(row[0], start)] + row[1:]
        if fresh:
            for i in range(1, n + 1):
                before[i] = min(before[i], before[i - 1] + 1)
        if c == " " and before[n] < far:
            best = before[n] if best is None else min(best, before[n])
        new = [before[0] + 1]
        for i in range(1, n + 1):
            new.append(min(before[i] + 1, new[i - 1] + 1, before[i - 1] + (phrase[i - 1] != c)))
        row = new
    return best


def brute_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute_base(w):
    places = [(i, n.label) for n in licenses.BASE for i in range(len(w)) if w[i:i + len(n.phrase.split())] == n.phrase.split()]
    starts = [i for i, _ in places]
    return (len(w), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places})))


def license_texts():
    rng = random.Random(4)
    texts = [None, "", " . ", "cc by", "CC-BY cc by", "MIT_License", "xmit license", "emit license", "the mit licenses", "GNU General\nPublic  License!",
             "mit license mit license apache license", "É cc by é", "cc by", "license " * 4000, "x" * 30_000 + " cc by"]
    for notice in licenses.BASE + licenses.NOTICES:
        for _ in range(2):
            p = list(notice.phrase)
            for _ in range(rng.randrange(0, notice.edits + 3)):
                at = rng.randrange(len(p))
                p[at:at + rng.randrange(0, 2)] = rng.choice(["", "q", " ", "é"])
            around = [" ".join(rng.choice(["alpha", "license", "the", "gnu", "public", "cc"]) for _ in range(rng.randrange(0, 9))) for _ in "ab"]
            texts.append(f"{around[0]} {''.join(p)}, {around[1]}")
    return texts


def test_license_scan_matches_brute_force(spark):
    docs = list(enumerate(license_texts()))
    df = spark.createDataFrame([(i, t, *"rcnm") for i, t in docs] + [(None, "cc by", *"rcnm")], CLASHING)
    rows = {r.doc_id: r for r in licenses.scan_licenses(df).collect()}
    every = licenses.BASE + licenses.NOTICES
    for i, t in docs:
        r, w = rows[i], brute_words(t)
        base = [m for m in r.matches if m.notice < len(licenses.BASE)]
        starts = [m.first_word for m in base]
        assert brute_base(w) == (r.n_words, len(base), min(starts, default=None), max(starts, default=None), ",".join(sorted({m.label for m in base})))
        if len(w) > 60:
            continue
        text = " " + " ".join(w) + " "
        for k, notice in enumerate(every):
            held = [m for m in r.matches if m.notice == k]
            least = least_edits(notice.phrase, text)
            assert bool(held) == (least is not None and least <= notice.edits), (notice, t)
            for m in held:
                span = " ".join(w[m.first_word:m.first_word + m.n_words])
                assert least_edits(notice.phrase, f" {span} ") <= m.edits <= notice.edits
    assert rows[None].matches[0].label == "cc-by"
    assert licenses.scan_licenses(df.limit(0)).collect() == []
    assert all(r.matches == [] for r in licenses.scan_licenses(df, ()).collect())


def test_windows_lose_nothing_of_a_whole_text_search():
    search = licenses.Searcher(licenses.BASE + licenses.NOTICES)
    for t in license_texts():
        text, n = licenses.normal_text(t)
        if n > 500:
            continue
        found = {(i, e) for i, _, _, e in search.search(text)}
        whole = {(i, sum(m.fuzzy_counts)) for i, p in enumerate(search.patterns) for m in p.finditer(text)}
        assert {i for i, _ in found} == {i for i, _ in whole}
    with pytest.raises(ValueError):
        licenses.pieces(licenses.Notice("x", "ab", 4))


def test_license_query_on_the_small_table(spark, sf_dir):
    got = {r.doc_id: r for r in queries.op12_license_scan(spark, sf_dir).collect()}
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}
    assert got.keys() == texts.keys()
    for i, t in texts.items():
        r = got[i]
        assert tuple(r)[1:6] == brute_base(brute_words(t))
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(",")))
        assert (r.score > 0) == bool(r.labels) and 0 <= r.score <= 1 and (not r.n_base or r.score == 1)
    assert any(r.n_base for r in got.values())


# ------------------------------------------------------------- clustering
def brute_clusters(rows, k=8, rounds=10, dim=64):
    kept = [(i, [int(np.floor(1024 * float(x))) for x in v]) for i, v in rows
            if v is not None and len(v) == dim and all(x is not None and np.isfinite(x) for x in v)]
    name = lambda i: hashlib.sha256(f"3:{'' if i is None else i}".encode()).hexdigest()
    centres = [v for _, _, v in sorted((name(i), tuple(v), v) for i, v in kept)[:k]]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    for turn in range(rounds + 1):
        at = [min((far(v, c), j) for j, c in enumerate(centres)) for _, v in kept]
        if turn < rounds:
            for j in range(len(centres)):
                own = [v for (_, v), (_, c) in zip(kept, at) if c == j]
                if own:
                    centres[j] = [sum(x) // len(own) for x in zip(*own)]
    cost = {j: sum(d for d, c in at if c == j) for j in range(len(centres))}
    shas = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return sorted(((-1 if i is None else i), c, d, cost[c], sum(cost.values()), shas[c]) for (i, _), (d, c) in zip(kept, at))


def vectors(seed, n, dim=64):
    rng = np.random.default_rng(seed)
    middle = rng.normal(0, 1, (12, dim))
    rows = [(int(i), [float(x) for x in middle[rng.integers(12)] + rng.normal(0, .3, dim)]) for i in range(n)]
    rows += [(n + i, rows[0][1]) for i in range(n // 3)]  # copies and ties
    rows += [(n // 2, rows[-1][1]), (None, rows[n // 3][1]), (n + 900, None), (n + 901, []), (n + 902, [0.0] * (dim - 1)), (n + 903, [0.0] * (dim + 1)),
             (n + 904, [float("nan")] * dim), (n + 905, [float("inf")] + [0.0] * (dim - 1)), (n + 906, [None] + [0.0] * (dim - 1)), (n + 907, [0.0] * dim)]
    return rows


def result_rows(df):
    return sorted((-1 if r.vec_id is None else r.vec_id, *tuple(r)[1:]) for r in df.collect())


@pytest.mark.parametrize("seed,n", [(1, 150), (2, 3)])
def test_clusters_match_brute_force(spark, seed, n):
    rows = vectors(seed, n)
    df = spark.createDataFrame([(i, v, 1, "u") for i, v in rows], "vec_id long, embedding array<double>, cluster int, upper string").repartition(5)
    got = centroids.cluster_vectors(df)
    assert result_rows(centroids.clustered(got)) == brute_clusters(rows)
    assert len(got.scanned) == 11 and got.scanned[0] == len(brute_clusters(rows))
    if n > 100:
        assert min(got.scanned[1:]) < got.scanned[0] / 2  # bounds spare most vectors of clear clusters


def test_clusters_of_nothing(spark):
    df = spark.createDataFrame([(1, None), (2, [1.0])], "vec_id long, embedding array<float>")
    assert centroids.clustered(centroids.cluster_vectors(df)).collect() == []
    big = spark.createDataFrame([(1, [1e9] * 4)], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="squared distances"):
        centroids.cluster_vectors(big, dim=4)


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 6))
def test_losses_bound_every_point_of_the_sphere(seed, dim):
    rng = np.random.default_rng(seed)
    old = rng.integers(-50, 50, (4, dim))
    new = old + rng.integers(-20, 20, (4, dim))
    radius = rng.uniform(0, 40, 4)
    loss = centroids.tight_losses(old, new, radius)
    drift = np.linalg.norm(new - old, axis=1)
    for i in range(4):
        assert loss[i] <= max(np.delete(drift, i)) * (1 + 1e-6) + 1e-9
        way = rng.normal(size=(200, dim))
        x = old[i] + way / np.linalg.norm(way, axis=1, keepdims=True) * radius[i] * rng.uniform(0, 1, (200, 1))
        for j in range(4):
            if j != i:
                lost = np.linalg.norm(x - old[j], axis=1) - np.linalg.norm(x - new[j], axis=1)
                assert lost.max() <= loss[i] + 1e-6


def test_cluster_query_matches_sql(spark, sf_dir):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{sf_dir}/embeddings.parquet')")
    want = con.sql(centroids.oracle())
    got = queries.op13_centroid_clusters(spark, sf_dir)
    assert sorted(tuple(r) for r in got.select(want.columns).collect()) == sorted(want.fetchall())
