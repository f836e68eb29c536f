"""Jaccard join, line dedup, chat formatting and fingerprints against brute force."""

import random
import re
from collections import Counter
from itertools import combinations

import duckdb
import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from tablewright.llm import chat, fingerprints, jaccard, lines, queries
from tablewright.llm.common import drop_tables
from tablewright.llm.vectors import U64
from tablewright.session import scratch_path, work_root
from tablewright.sinks import store

SPACE = re.compile(r"[\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, n_lines string, score string, _th string"


def words(text):
    return [w for w in SPACE.split(text or "") if w]


def shingles(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = words(lower)
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute_components(docs):
    sets = {i: shingles(t) for i, t in docs}
    low = {i: i for i in sets}

    def find(i):
        while low[i] != i:
            i = low[i]
        return i
    for a, b in combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
            x, y = sorted((find(a), find(b)))
            low[y] = x
    return {(i, len(s), find(i)) for i, s in sets.items()}


def corpus(seed, n=120):
    """Copies, near copies around the threshold, a passage that many share, chains, short and odd texts."""
    rng = random.Random(seed)
    vocab = [f"w{k}" for k in range(400)]
    passage = [rng.choice(vocab) for _ in range(60)]
    base = [rng.choice(vocab) for _ in range(90)]
    texts = ["", None, " \n\t", "One", "one", "one two three", "ONE two\tthree", "É a b c d e", "é a b c d e", "x " * 40]
    for k in range(n):
        kind = k % 6
        if kind == 0:
            w = list(base)
            for _ in range(rng.randrange(0, 5)):
                w[rng.randrange(len(w))] = rng.choice(vocab)
        elif kind == 1:
            w = [rng.choice(vocab) for _ in range(rng.randrange(5, 90))] + passage
        elif kind == 2:
            w = passage + [rng.choice(vocab) for _ in range(rng.randrange(0, 12))]
        elif kind == 3:
            w = base[rng.randrange(0, 20):]
        elif kind == 4:
            w = [rng.choice(vocab) for _ in range(rng.randrange(1, 40))]
        else:
            w = texts[-1].split() if texts[-1] else ["a"]
            w = w + [rng.choice(vocab)] if rng.random() < 0.5 else w[:-1] or ["b"]
        texts.append(rng.choice([" ", "\n", "  "]).join(w).title() if rng.random() < 0.2 else " ".join(w))
    ids = list(range(100, 100 + 3 * len(texts), 3))
    rng.shuffle(ids)
    return list(zip(ids, texts))


@pytest.mark.parametrize("seed", [1, 2])
def test_jaccard_matches_brute_force(spark, seed, monkeypatch):
    monkeypatch.setattr(jaccard, "PAIR_DF", 4)  # so that pairs and triples are used on a small table
    docs = corpus(seed)
    df = spark.createDataFrame([(i, t, "x", "y", "z") for i, t in docs], DOCS)
    got = jaccard.jaccard_components(df)
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    assert {tuple(r) for r in got.collect()} == brute_components(docs)
    kept = jaccard.one_of_each_group(df)
    assert kept.columns == df.columns
    want = {c for i, n, c in brute_components(docs) if n} | {i for i, n, _ in brute_components(docs) if not n}
    assert sorted(r.doc_id for r in kept.collect()) == sorted(want)


@pytest.mark.parametrize("seed", [3, 4])
def test_jaccard_large_cells_match_brute_force(spark, seed, monkeypatch):
    """Every cell with unlinked members goes the way of large ones; pages of one template are among them."""
    monkeypatch.setattr(jaccard, "PAIR_DF", 4)
    monkeypatch.setattr(jaccard, "LARGE_CELL", 0)
    rng = random.Random(seed)
    docs = corpus(seed)
    template = [f"t{k}" for k in range(60)]
    pages = [template + [f"p{seed}x{i}y{k}" for k in range(rng.randrange(12, 30))] for i in range(40)]
    pages += [p + ["tail"] * rng.randrange(1, 4) for p in pages[::5]]
    start = max(i for i, _ in docs) + 1
    docs += [(start + i, " ".join(p)) for i, p in enumerate(pages)]
    seen = []
    real = jaccard._inner_entries
    monkeypatch.setattr(jaccard, "_inner_entries", lambda large, *a: seen.append(large.count()) or real(large, *a))
    got = jaccard.jaccard_components(spark.createDataFrame([(i, t, "x", "y", "z") for i, t in docs], DOCS))
    assert {tuple(r) for r in got.collect()} == brute_components(docs)
    assert seen and seen[0] > 40


def test_jaccard_template_pages_do_not_meet(spark):
    """Unlinked pages of a template are in one cell, yet no two meet inside it; linked ones do."""
    template = list(range(1, 76))
    # 100 tokens each: 75 of the template, the rest of the page alone, but for 13 that pages 299 and 300 share
    both = list(range(1001, 1014))
    sets = spark.createDataFrame([(i, 100, template + (both if i >= 299 else [])) for i in range(1, 301)],
                                 "node long, n int, tokens array<long>")
    cells = spark.createDataFrame([(0, i) for i in range(1, 301)], "centre long, node long")
    seekers, members = jaccard._inner_cells(
        jaccard._inner_entries(cells.selectExpr("centre", "node", "node AS comp", "true AS seeks"), sets, 0.75))
    met = seekers.alias("s").join(members.alias("m"), "cell").where("s.node < m.node").selectExpr("s.node AS a", "m.node AS b").distinct()
    assert [tuple(r) for r in met.collect()] == [(299, 300)]
    assert {tuple(sorted(r)) for r in jaccard._block_links(seekers, members, sets, 0.75).collect()} == {(299, 300)}


def test_step_tables_that_nothing_reads_are_deleted(spark):
    df = spark.createDataFrame([(i, t, "x", "y", "z") for i, t in corpus(6)], DOCS)

    def left():
        return Counter(n.rsplit("-", 1)[0] for n in store.names(spark, work_root(spark)) if n.startswith("llm-"))

    before = left()
    jaccard.jaccard_components(df).collect()
    lines.dedup_lines(df).collect()
    with_files = {n for n, k in (left() - before).items() if k}
    # those that the results, which are made when they are read, still use; tables without rows may stay
    assert with_files >= {"llm-sets", "llm-nodes", "llm-labels", "llm-distinct-lines", "llm-near-lines"}
    assert not with_files & {"llm-index", "llm-cells", "llm-line-variants", "llm-candidate-lines", "llm-edges"}
    with pytest.raises(ValueError):
        path = scratch_path(spark, "other")
        df.write.parquet(path)
        drop_tables(spark.read.parquet(path))


def test_jaccard_documents_are_numbered_in_a_set_order(spark):
    """A task that runs again may get its rows in another order; a flush must keep its documents and its name."""
    texts = [(t or "",) for _, t in corpus(5)]
    got = [[r.text for r in jaccard._in_set_order(spark.createDataFrame(rows, "text string").coalesce(1)).collect()]
           for rows in (texts, texts[::-1], sorted(texts))]
    assert got[0] == got[1] == got[2] and sorted(got[0]) == sorted(t for (t,) in texts)


def test_jaccard_edge_rows(spark):
    assert jaccard.jaccard_components(spark.createDataFrame([], DOCS)).collect() == []
    long = " ".join(f"v{k}" for k in range(30_000))
    rows = [(5, long), (3, long + " more"), (3, long + " more"), (None, long), (None, "alone here"), (9, None), (9, "")]
    got = [tuple(r) for r in jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert sorted(got, key=str) == sorted([(5, 29996, 3), (3, 29997, 3), (3, 29997, 3), (None, 29996, 3), (None, 1, None),
                                           (9, 0, 9), (9, 0, 9)], key=str)


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**6), st.integers(4, 120), st.floats(0, 0.3))
def test_linked_sets_share_a_combination(seed, n, change):
    """Any two sets at the threshold share an index key, whatever classes their tokens are in."""
    rng = np.random.default_rng(seed)
    pool = rng.integers(1, 2**63, 400, dtype=np.uint64)
    df = dict(zip(pool.tolist(), rng.choice([2, 3, 40, 500, jaccard.HEAVY_DF], 400)))
    a = rng.choice(pool, n, replace=False)
    keep = rng.random(n) >= change * rng.random()
    fresh = rng.choice(np.setdiff1d(pool, a), int(rng.integers(0, max(1, n // 4))), replace=False)
    b = np.concatenate([a[keep], fresh])
    both = int(keep.sum())
    if not both or 100 * both < 75 * (len(a) + len(b) - both):
        return
    keys = [set(jaccard.combination_keys(np.sort(x).astype(U64), np.array([df[int(t)] for t in np.sort(x)], np.int32), len(x), 0.75))
            for x in (a, b)]
    assert keys[0] & keys[1]


@pytest.mark.parametrize("threshold", [0.1, 0.2, 0.3, 0.37, 0.5, 0.75, 0.9])
def test_linked_sets_share_a_combination_at_any_threshold(threshold):
    rng = np.random.default_rng(3)
    for _ in range(150):
        n = int(rng.integers(1, 50))
        pool = rng.integers(1, 2**63, 130, dtype=np.uint64)
        df = dict(zip(pool.tolist(), rng.choice([[2, 40, jaccard.HEAVY_DF], [40, 500, jaccard.HEAVY_DF]][int(rng.integers(2))], 130)))
        a = pool[:n]
        both = int(rng.integers(1, n + 1))
        most = int(both / threshold) - n  # of the partner's own tokens
        if most < 0:
            continue
        b = np.concatenate([rng.permutation(a)[:both], pool[n:n + min(most, 60)]])
        assert both >= threshold * (n + len(b) - both) - 1e-9
        keys = [set(jaccard.combination_keys(np.sort(x), np.array([df[int(t)] for t in np.sort(x)], np.int32), len(x), threshold))
                for x in (a, b)]
        assert keys[0] & keys[1]


def test_jaccard_links_rows_without_id(spark):
    base = [f"v{k}" for k in range(60)]
    near = lambda word: " ".join([*base, word])
    other = " ".join(f"u{k}" for k in range(60))
    rows = [(7, near("a")), (None, near("b")), (None, near("b").upper()), (None, near("c")), (None, near("c")),
            (None, other + " x"), (None, other + " y"), (None, "alone")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((tuple(r) for r in jaccard.jaccard_components(df).collect()), key=str)
    assert got == sorted([(7, 57, 7)] + [(None, 57, 7)] * 4 + [(None, 57, None)] * 2 + [(None, 1, None)], key=str)
    kept = jaccard.one_of_each_group(df).collect()
    assert sorted(r.text.split()[0] for r in kept) == ["alone", "u0", "v0"] and [r.doc_id for r in kept if r.doc_id] == [7]


# ------------------------------------------------------------- line dedup
def within_one(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) <= 1
    short, long = sorted((a, b), key=len)
    return len(long) - len(short) == 1 and any(long[:i] + long[i + 1:] == short for i in range(len(long)))


def brute_lines(docs, min_words=8):
    spots = sorted((i, p, words(line)) for i, t in docs for p, line in enumerate((t or "").split("\n")) if words(line))
    first = {}
    for i, p, w in spots:
        first.setdefault(tuple(w), (i, p))
    near = {w for w in first if any(o != w and first[o] < first[w] and max(len(o), len(w)) >= min_words and within_one(o, w)
                                    for o in first)}
    stay = {s for w, s in first.items() if w not in near}
    out = []
    for i, t in docs:
        all_lines = (t or "").split("\n")
        held = [(p, line) for p, line in enumerate(all_lines) if not words(line) or (i, p) in stay]
        n = sum(bool(words(line)) for line in all_lines)
        out.append((i, None if t is None else "\n".join(line for _, line in held), n, len(all_lines) - len(held)))
    return sorted(out)


def line_corpus(seed):
    rng = random.Random(seed)
    pool = [" ".join(rng.choice("abcdefghij") + str(rng.randrange(6)) for _ in range(rng.randrange(1, 14))) for _ in range(40)]
    docs = [(0, None), (1, ""), (2, "\n\n"), (3, "  \n x \n\tx")]
    for i in range(4, 44):
        out = []
        for _ in range(rng.randrange(1, 7)):
            w = rng.choice(pool).split()
            change = rng.randrange(5)
            if change == 0:
                w[rng.randrange(len(w))] = "z"
            elif change == 1:
                w.insert(rng.randrange(len(w) + 1), "q")
            elif change == 2 and len(w) > 1:
                del w[rng.randrange(len(w))]
            out.append(("  " if rng.random() < 0.2 else "") + " ".join(w))
        docs.append((i, "\n".join(out)))
    return docs


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        last, row[0] = row[0], i + 1
        for k, y in enumerate(b):
            last, row[k + 1] = row[k + 1], min(row[k + 1] + 1, row[k] + 1, last + (x != y))
    return row[-1]


LINE_NAMES = ("_id _th _kid _kth _kept _parts _blank _text _rest _pos _raw _line _n _h _k1 _k2 _f _half _j _short _long _m _cid _cth _at _c _w _o _p "
              "_mine _theirs c0 c1 v h1 h2 kind rows any whole deleted")


@pytest.mark.parametrize("seed,edits", [(3, 1), (4, 1), (5, 0), (6, 2)])
def test_lines_match_brute_force(spark, seed, edits, monkeypatch):
    docs = line_corpus(seed)
    names = LINE_NAMES.split()
    df = spark.createDataFrame([(i, t, *names) for i, t in docs], "doc_id long, text string, " + ", ".join(f"{c} string" for c in names))
    got = lines.dedup_lines(df, edits=edits)
    assert got.columns == ["doc_id", "text", *names, "n_lines", "n_removed"]
    if edits != 1:
        monkeypatch.setitem(globals(), "within_one", lambda a, b: edits > 0 and edit_distance(a, b) <= edits)
    rows = got.collect()
    assert sorted((r.doc_id, r.text, r.n_lines, r.n_removed) for r in rows) == brute_lines(docs)
    assert all(tuple(r)[2:-2] == tuple(names) for r in rows)


def test_lines_edge_rows(spark):
    assert lines.dedup_lines(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    long = " ".join(f"v{k}" for k in range(20_000))
    rows = [(2, long), (7, long + " more"), (7, long + " more"), (None, "a b c d e f g h"), (1, "a b c d e f g i\nrest")]
    got = lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(((r.doc_id, r.text, r.n_lines, r.n_removed) for r in got), key=str) == sorted(
        [(2, long, 1, 0), (7, "", 1, 1), (7, "", 1, 1), (None, "a b c d e f g h", 1, 0), (1, "rest", 2, 1)], key=str)


# ------------------------------------------------------------- chats
def test_chats_collapse_snapshots(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "assistant", "b"),
            (2, 0, "user", "a"), (2, 1, "assistant", "b"), (2, 2, "user", "c"),
            (3, 5, "user", "a"), (3, 6, "assistant", "b"), (3, 7, "user", "c"),   # equal to 2 whatever the turn numbers
            (4, 1, "assistant", "b"), (4, 0, None, "a<|im_end|>"), (4, 0, None, "a<|im_end|>"),
            (5, None, None, None), (6, 0, "user", "b"), (None, 0, "user", "lost")]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, k string, n int")
    got = {r.conv_id: tuple(r)[1:] for r in chat.format_chats(df).collect()}
    turn = lambda role, text: f"<|im_start|>{role}\n{text}<|im_end|>\n"
    assert got == {
        2: (3, 2, turn("user", "a") + turn("assistant", "b") + turn("user", "c"), 1),
        4: (2, 1, turn("unknown", "a< |im_end|>") + turn("assistant", "b"), 1),
        5: (1, 1, turn("unknown", ""), 0),
        6: (1, 1, turn("user", "b"), 0),
        None: (1, 1, turn("user", "lost"), 0)}
    assert chat.format_chats(df.limit(0)).collect() == []


def test_turns_without_conversation_stand_alone(spark):
    rows = [(None, 0, "user", "hi"), (None, 0, "user", "hi"), (None, 3, "user", "hi"),   # a repeated row, and a copy
            (None, 1, "assistant", "b"), (None, 0, "user", "a"), (None, None, None, None), (None, 2, "user", "z"),
            (8, 0, "user", "a"), (8, 1, "assistant", "b"), (9, 4, "user", "z")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = sorted((str(r.conv_id), r.n_turns, r.n_copies, r.text.count("<|im_start|>"), r.trained_chars) for r in chat.format_chats(df).collect())
    # ("a" opens conversation 8; conversation 9 stands for the lone "z")
    assert got == [("8", 2, 1, 2, 1), ("9", 1, 2, 1, 0), ("None", 1, 1, 1, 0), ("None", 1, 1, 1, 1), ("None", 1, 2, 1, 0)]


def test_chats_match_sql(spark):
    rng = random.Random(6)
    log = []
    for c in range(60):
        log += [(None if c % 7 == 0 else c, t, rng.choice(["user", "assistant", None]), rng.choice(["a", "b", None])) for t in range(rng.randint(1, 5))]
    log += [(None, 0, "user", text) for text in ("own", "own too", "own")]
    log += [(500, t, "user", f"turn {t} " + "x" * 50) for t in range(3000)] + [(501, t, "user", f"turn {t} " + "x" * 50) for t in range(2999)]
    df = spark.createDataFrame(log, "conv_id long, turn long, role string, text string")
    con = duckdb.connect()
    con.register("conversations", df.toArrow())
    want = con.sql(chat.ORACLE).fetchall()
    got = [tuple(r) for r in chat.format_chats(df).select("conv_id", "n_turns", "n_copies", "text", "trained_chars").collect()]
    assert Counter(got) == Counter(want) and sum(r[0] is None for r in got) > 1


# ------------------------------------------------------------- fingerprints
def signed(x):
    return x - 2**64 if x >= 2**63 else x


def long_hash(values):
    seed = 42
    for v in values:
        seed = xxhash.xxh64_intdigest((v % 2**64).to_bytes(8, "little"), seed)
    return signed(seed)


def brute_starts(text, k=fingerprints.K, s=fingerprints.S):
    """First tokens of the closed syncmers."""
    toks = re.findall(fingerprints.TOKEN, (text or "").lower())
    h = [signed(xxhash.xxh64_intdigest(t.encode(), 42)) for t in toks]
    m = [long_hash(h[i:i + s]) for i in range(len(h) - s + 1)]
    return toks, [i for i in range(len(h) - k + 1)
                  if min(m[i], m[i + k - s]) == min(m[i:i + k - s + 1])]


def test_fingerprints(spark):
    rng = random.Random(8)
    vocab = [f"w{k}" for k in range(300)]
    docs = [(k * 7 % 61, " ".join(rng.choice(vocab) for _ in range(rng.choice([0, 1, 5, 8, 40, 300])))) for k in range(30)]
    docs += [(200, None), (201, docs[0][1]), (202, "Ünï cödé " * 30), (203, "x" * 5000)]
    df = spark.createDataFrame([(i, t, "n", "s", "t") for i, t in docs], DOCS)
    got = {r.doc_id: r for r in fingerprints.fingerprint_documents(df).collect()}
    order = sorted(docs)
    import hashlib
    for n, (i, t) in enumerate(order):
        t, after = t or "", order[(n + 1) % len(order)][1] or ""
        half = len(t) // 2
        edited = t[:len(t) - half] + after[:half]
        r = got[i]
        assert r.n_chars == len(t)
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        for text, found in ((t, r.fingerprint), (edited, r.edited_fingerprint)):
            toks, starts = brute_starts(text)
            want = 0 if not toks else 1 if len(toks) < fingerprints.K else len(starts)
            assert len(found) == 8 * want
        cut = lambda f: {f[a:a + 8] for a in range(0, len(f), 8)}
        for other, near in ((r.edited_fingerprint, r.near_edited), (got[order[(n + 1) % len(order)][0]].fingerprint, r.near_next)):
            union = cut(r.fingerprint) | cut(other)
            assert near == pytest.approx(len(cut(r.fingerprint) & cut(other)) / len(union) if union else 1.0)
    assert got[201].fingerprint == got[docs[0][0]].fingerprint
    assert fingerprints.fingerprint_documents(df.limit(0)).collect() == []
    alone = fingerprints.fingerprint_documents(spark.createDataFrame([(4, "abcd"), (4, "abcd")], "doc_id long, text string")).collect()
    assert [r.edited_sha256 for r in alone] == [hashlib.sha256(b"abab").hexdigest()] * 2


def test_different_short_texts_are_not_alike(spark, tmp_path):
    rng = random.Random(9)
    texts = [" ".join(f"{rng.choice('abcdefgh')}{rng.randrange(10**6)}" for _ in range(n)) for n in range(1, 16) for _ in range(30)]
    missed = [t for t in texts if len(t.split()) >= fingerprints.K and not brute_starts(t)[1]]
    assert {len(t.split()) for t in missed} >= {8, 9, 10, 11}
    docs = [*enumerate(texts), (1000, None), (1001, " \n"), (1002, missed[0]), (1003, missed[0].upper()), (1004, texts[0] + "x")]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in queries.op9_fingerprints(spark, str(tmp_path)).collect()}
    marks = [got[k].fingerprint for k, _ in enumerate(texts)]
    assert all(marks) and len(set(marks)) == len(marks)
    assert all(len(marks[texts.index(t)]) == 8 for t in missed)
    assert got[1000].fingerprint == got[1001].fingerprint == ""
    assert {k: r.near_next for k, r in got.items() if r.near_next} == {1000: 1.0, 1002: 1.0}
    assert not [k for k, r in got.items() if r.near_edited == 1.0 and texts.count(dict(docs)[k]) and dict(docs)[k] in missed]
