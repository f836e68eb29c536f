"""Quality rules, quality classifier, HTML extraction, language id, mixing and packing."""

import math
import random
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tablewright.llm import html_text, langid, mixing, packing, quality, rules

SPACE = re.compile(r"[\x20\x09-\x0D]+")
CLASHING = "doc_id long, text string, score string, _th string, n_words string"


def words(text):
    return [w for w in SPACE.split(text or "") if w]


# ------------------------------------------------------------- rules
def brute_counts(text):
    w = words(text)
    grams = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    covered = {i + k for i in range(len(w) - 2) if grams[tuple(w[i:i + 3])] > 1 for k in range(3)}
    held = [x for x in (text or "").split("\n") if words(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(held) - len(set(held)), len(covered))


def brute_kept(text):
    n, chars, symbols, dup, rep = brute_counts(text)
    if n < 50 or 100 * rep > 50 * n:
        return True, False
    w = words(text)
    held = [x for x in text.split("\n") if words(x)]
    letters, capitals = sum(c.isalpha() for c in text), sum(c.isupper() for c in text)
    return False, not (
        10 * symbols > n or chars < 2 * n or chars > 12 * n or 2 * dup > len(held) or 5 * text.count("!") > n
        or 5 * sum(c in "0123456789" for c in text) > chars or 10 * capitals > 3 * letters
        or 5 * sum(not any(c.isalpha() for c in x) for x in w) > n or 10 * sum(a == b for a, b in zip(w, w[1:])) > n
        or 10 * sum(bool(re.match("[ \t]*[-*•]", x)) for x in held) > 9 * len(held)
        or 10 * sum(bool(re.search("(\\.\\.\\.|…)[ \t]*$", x)) for x in held) > 3 * len(held))


def rule_texts():
    rng = random.Random(5)
    vocab = ["".join(rng.choice("abcdeéß") for _ in range(rng.randrange(2, 9))) for _ in range(300)]
    prose = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    texts = [None, "", " \n\t ", "a b", prose(49), prose(50), prose(300), prose(20_000), prose(80).upper(), prose(80).replace(" ", "!! "),
             "\n".join([prose(10)] * 9), " | ".join(vocab[:80]), prose(60) + "\n" + " ".join(["la"] * 20), "x" * 3000 + " " + prose(60),
             "\n".join("- " + prose(8) for _ in range(9)), "\n".join(prose(8) + "..." for _ in range(9)),
             " ".join(str(rng.randrange(10**6)) for _ in range(70)), (prose(30) + " ") * 3, prose(60) + " a b c d a b c e"]
    return texts + [t for t in texts[5:8]]


def test_rules_match_brute_force(spark):
    docs = list(enumerate(rule_texts()))
    df = spark.createDataFrame([(i, t, "s", "t", "n") for i, t in docs], CLASHING)
    got = {r.doc_id: tuple(r)[1:] for r in rules.quality_rules(df).collect()}
    assert got == {i: (*brute_counts(t), *brute_kept(t)) for i, t in docs}
    assert rules.quality_rules(df.limit(0)).collect() == []


def test_rules_are_ordered_by_what_is_left():
    a, b, c = (rules.Rule(n, lambda: None) for n in "abc")
    fails = [[True, True, False]] * 6 + [[False, False, True]] * 2 + [[False, False, False]] * 2
    got = rules.order_rules([a, b, c], [1.0, 1.1, 1.0], fails)
    assert [(m.rule.name, m.rejects) for m in got] == [("a", .6), ("c", .5), ("b", 0.0)]  # b rejects nothing that a keeps
    got = rules.order_rules([a, b, c], [9.0, 1.0, 1.0], fails)
    assert [m.rule.name for m in got] == ["b", "c", "a"]
    assert [m.rejects for m in rules.order_rules([a, b], [1.0, 1.0], [])] == [0.0, 0.0]


def test_cascade_order_changes_no_verdict(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(rule_texts())], "doc_id long, text string")
    measured = rules.measure_rules(df, "doc_id", "text")
    assert sorted(m.rule.name for m in measured) == sorted(r.name for r in rules.DEFAULT_RULES)
    assert measured[0].gain == max(m.gain for m in measured) and all(m.seconds > 0 for m in measured)
    counted = rules.with_counts(df, "doc_id", "text")
    backwards = counted.select("doc_id", rules.cascade(list(reversed(rules.DEFAULT_RULES))).alias("kept"))
    want = {r.doc_id: r.kept for r in rules.quality_rules(df).collect()}
    assert {r.doc_id: r.kept for r in backwards.collect()} == want
    # a filter on the verdict must not compute the words once per word
    assert {r.doc_id for r in rules.quality_rules(df).where("kept").collect()} == {i for i, k in want.items() if k}


# ------------------------------------------------------------- classifier
def test_margins_equal_all_pairs():
    rng = np.random.default_rng(1)
    model = quality.Machine(0.3, rng.normal(size=quality.FEATURES), rng.normal(size=(quality.FEATURES, 4)))
    rows = [np.sort(rng.choice(quality.FEATURES, k, replace=False)) for k in (1, 5, 9)]
    values = [rng.normal(size=len(r)) for r in rows]
    got = model.margins(np.repeat(np.arange(3), [len(r) for r in rows]), np.concatenate(rows), np.concatenate(values), 3)
    for r, x, g in zip(rows, values, got):
        want = model.w0 + model.w[r] @ x + sum(model.v[r[i]] @ model.v[r[j]] * x[i] * x[j] for i in range(len(r)) for j in range(i))
        assert g == pytest.approx(want)


def test_word_features_count_whole_texts():
    long = "one two Two  three\x0bthree " * 50_000
    column = pa.array([None, "", "One two", long, " ~ # word"])
    seen = {}
    for first, rows, row, feature, value in quality.features(column):
        for i in range(rows):
            seen[first + i] = {f: v for f, v in zip(feature[row == i], value[row == i])}
    assert sorted(seen) == [0, 1, 2, 3, 4]
    share = lambda i, name: seen[i][quality.WORD_BUCKETS + quality.SHARES.index(name)]
    assert share(3, "repeated") == pytest.approx(0.4) and share(3, "capitals") == pytest.approx(1 / 19)
    assert share(4, "letterless") == pytest.approx(2 / 3) and share(4, "symbols") == pytest.approx(2 / 3)
    assert share(2, "distinct") == 1 and share(0, "bias") == 1


def test_classifier_on_held_out_rows(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir.replace('0.001', '0.01')}/{t}.parquet") for t in ("documents", "labels"))
    model = quality.train_quality(docs.select("doc_id", "text"), labels)
    scored = quality.score_quality(docs.withColumn("score", docs.lang), model)
    assert scored.columns == [*docs.columns, "score", "predicted"]
    found = scored.withColumn("out", quality.held_out("doc_id")).join(labels, "doc_id").toPandas()
    out = found[found.out]
    assert len(out) > 40 and (out.predicted == out.quality).mean() > 0.95
    assert all(zlib.crc32(str(i).encode()) % 5 == 0 for i in out.doc_id)
    odd = spark.createDataFrame([(1, None), (2, ""), (None, "x " * 50_000), (3, "a"), (3, "a")], "doc_id long, text string")
    rows = quality.score_quality(odd, model).collect()
    assert len(rows) == 5 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert quality.score_quality(odd.limit(0), model).collect() == []
    none = quality.train_quality(docs.limit(0).select("doc_id", "text"), labels.limit(0))
    assert len(quality.score_quality(odd, none).collect()) == 5


# ------------------------------------------------------------- languages
def test_languages_on_held_out_rows(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir.replace('0.001', '0.01')}/documents.parquet").select("doc_id", "text", "lang")
    model = langid.train_languages(docs, rows_per_language=150)
    assert (model.weights == 0).mean() > 0.5  # the L1 penalty leaves most weights at zero
    found = langid.identify_languages(docs, model).withColumn("out", langid.held_out("doc_id")).toPandas()
    out = found[found.out & found.lang.notna() & (found.lang_pred != "und")]
    assert (out.lang == out.lang_pred).mean() > 0.97
    assert all(zlib.crc32(str(i).encode()) % 4 == 2 for i in out.doc_id)
    assert abs(out.score.mean() - (out.lang == out.lang_pred).mean()) < 0.05  # calibrated
    odd = spark.createDataFrame([(1, None, "k"), (2, "", "k"), (3, "12 --", "k"), (4, "der und die " * 9000, "k"), (4, "a", "k")],
                                "doc_id long, text string, score string")
    rows = langid.identify_languages(odd, model).collect()
    assert [r.lang_pred == "und" for r in sorted(rows, key=lambda r: r.doc_id)[:3]] == [True] * 3
    assert all(0 <= r.score <= 1 for r in rows) and len(rows) == 5
    assert langid.identify_languages(odd.limit(0), model).collect() == []
    none = langid.train_languages(docs.limit(0))
    assert {r.lang_pred for r in langid.identify_languages(odd, none).collect()} == {"und"}


def _plain_grams(text):
    """Counts of the hashed n-grams of a text, one n-gram at a time."""
    t = " " + re.sub(r"[\W\d_]+", " ", text.lower()).strip() + " "
    found = Counter()
    for n in langid.ORDERS:
        for i in range(len(t) - n + 1):
            key = 0
            for c in t[i:i + n]:
                key = key * 1_000_003 + ord(c)
            found[(((key & 0x7FFFFFFFFFFF) * 0x9E3779B1 + n * 7919) >> 13) % langid.BUCKETS] += 1
    return found


def test_languages_match_brute_force(spark):
    """Sample, idf and scores, one document and n-gram at a time; a hot language and names that clash."""
    words = {"aa": "der die und nicht ein haus", "bb": "the of and not a house", "cc": "le la et pas une maison"}
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choices(words[lang].split(), k=rng.randint(1, 30))) + rng.choice(["", " 7", "!", " Ää"]), lang)
            for i in range(900) for lang in ["cc" if i % 40 == 0 else "bb" if i % 9 == 0 else "aa"]]
    rows += rows[:5] + [(2000, None, "aa"), (2001, "12", "bb"), (None, "haus", "aa"), (2003, "x", None), (2004, "\U0001d49c" * 3, "cc")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    docs = docs.select("*", *[F.lit("k").alias(c) for c in ("id", "hash", "ids", "rank", "row", "able", "index", "count", "a.b")])
    per = 40
    model = langid.train_languages(docs, rows_per_language=per)
    hashes = {r.doc_id: r.h for r in docs.select("doc_id", F.xxhash64(F.col("doc_id").cast("string")).alias("h")).collect()}
    able = {(i, lang, t) for i, t, lang in rows if i is not None and t is not None and lang and zlib.crc32(str(i).encode()) % 4 != 2}
    sample = []
    for lang in words:
        sample += [t for _, _, t in sorted((hashes[i], i, t) for i, at, t in able if at == lang)[:per] if re.search("[^\\W\\d_]", t)]
    holding = Counter(g for t in sample for g in _plain_grams(t))
    idf = [math.log((1 + len(sample)) / (1 + holding[g])) + 1 for g in range(langid.BUCKETS)]
    assert model.languages == sorted(words) and np.allclose(model.idf, idf)
    got = langid.identify_languages(docs, model)
    assert got.columns == [*docs.columns, "lang_pred", "score"]
    for r in got.collect():
        assert r.rank == r.able == r["a.b"] == "k"
        if r.text is None or not re.search("[^\\W\\d_]", r.text):
            assert (r.lang_pred, r.score) == ("und", 0)
            continue
        value = {g: (1 + math.log(n)) * idf[g] for g, n in _plain_grams(r.text).items()}
        norm = math.sqrt(sum(v * v for v in value.values()))
        z = [(sum(v * model.weights[g][k] for g, v in value.items()) / norm + model.bias[k]) / model.temperature for k in range(3)]
        e = [math.exp(x - max(z)) for x in z]
        assert r.lang_pred == model.languages[z.index(max(z))] and abs(r.score - max(e) / sum(e)) < 1e-9


def test_fit_follows_the_regularised_leader():
    """Batched, sparse steps give the weights of the textbook update, a coordinate at a time."""
    rng = np.random.default_rng(1)
    rows = [(np.sort(rng.choice(langid.BUCKETS, 6, replace=False) % 12), rng.random(6)) for _ in range(8)]
    rows = [(np.unique(i), v[:len(np.unique(i))]) for i, v in rows]
    y = rng.integers(0, 2, 8)
    weights, bias = langid.fit_ftrl(rows, y, 2, epochs=2, batch=1, seed=5)
    order, z, n = np.random.default_rng(5), Counter(), Counter()

    def weight(f, c):
        l1 = 0 if f == -1 else 0.002
        return 0.0 if abs(z[f, c]) <= l1 else -(z[f, c] - math.copysign(l1, z[f, c])) / ((1 + math.sqrt(n[f, c])) / 1 + 0.001)

    for _ in range(2):
        for k in order.permutation(8):
            x = dict(zip(rows[k][0].tolist(), rows[k][1])) | {-1: 1.0}
            logit = [sum(v * weight(f, c) for f, v in x.items()) for c in range(2)]
            total = sum(math.exp(v) for v in logit)
            old = {(f, c): weight(f, c) for f in x for c in range(2)}
            for (f, c), w in old.items():
                g = (math.exp(logit[c]) / total - (y[k] == c)) * x[f]
                step = math.sqrt(n[f, c] + g * g) - math.sqrt(n[f, c])
                n[f, c] += g * g
                z[f, c] += g - step * w
    assert np.allclose(bias, [weight(-1, c) for c in range(2)])
    assert np.allclose(weights[:12], [[weight(f, c) for c in range(2)] for f in range(12)])


# ------------------------------------------------------------- pages
PAGE = """<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{}</style><script>var a = "</p><p>no";</script></head><body>
<header class="site-header"><a href=/>Home</a></header><nav><ul><li><a>Menu</a></li></ul></nav>
<div id="cookie-notice">We use cookies</div><!-- <p>hidden</p> --><div class="ad-slot">Buy now</div>
<article><h1>A &lt;title&gt;</h1><p>First&nbsp;block of
   words, <em>all</em> of it &eacute;.<br>More.<p>Second one<div class="share-buttons">Share me</div>
<form><input name=q><button>Go</button></form><aside>Aside</aside><ul><li>Point one<li>Point two</ul><p>Last.</p></article>
<section class="comments"><p>A reader says a lot of things here, more than the article does, on and on and on.</p></section>
<div class="sidebar-left"><p>Popular things</p></div><footer>&copy; Us</footer></body></html>"""
MAIN = "A <title>\n\nFirst block of words, all of it é. More.\n\nSecond one\n\nPoint one\n\nPoint two\n\nLast."


def test_main_text():
    assert html_text.main_text(PAGE, html_text.Weights()) == MAIN
    assert html_text.main_text(None, html_text.Weights()) == ""
    assert html_text.main_text("<p", html_text.Weights()) == ""
    assert html_text.main_text("only words <b>here</b>", html_text.Weights()) == "only words here"
    wrapped = '<body><div class="has-sidebar"><div id=page><article class="post"><div class="entry-header"><h1>T</h1></div><p>a b c</p>'
    assert html_text.main_text(wrapped + '<div class="comments"><article>no</article></div></article>', html_text.Weights()) == "T\n\na b c"
    only_comments = '<p>a b c d e</p><section class="comments"><article class="comment"><p>no no</p></article></section>'
    assert html_text.main_text(only_comments, html_text.Weights()) == "a b c d e"
    deep = "<div>" * 2000 + "<p>" + "word " * 20_000 + "</p>"
    assert len(html_text.main_text(deep, html_text.Weights()).split()) == 20_000


def test_marks_do_not_cut_the_article():
    text = lambda page: html_text.main_text(f"<body>{page}</body>", html_text.Weights()).split()
    said = lambda name, n: f"<p>{' '.join([name] * n)}</p>"
    article = said("a", 60)
    for name in ("post hentry category-social-media tag-privacy", "post comments-open"):  # an article's own class
        assert text(f'<article class="{name}">{article}</article>') == ["a"] * 60
        assert text(f'<main class="no-sidebar"><article class="{name}">{article}</article></main>') == ["a"] * 60
        assert text(f'<div class="has-sidebar"><article class="{name}">{article}</article></div>') == ["a"] * 60
        small = f'<div class="teasers"><article>{said("t", 3)}</article></div>'
        assert text(f'<article class="{name}">{article}</article>{small}').count("a") == 60
    for name in ("content has-sidebar", "page no-sidebar"):  # pages without article
        page = f'<div class="{name}">{article}<div class="sidebar">{said("s", 9)}</div></div><div class="promo">{said("p", 20)}</div>'
        assert text(page) == ["a"] * 60
        assert text(f'<div class="{name}"><div class="{name}">{article}</div></div>') == ["a"] * 60
        assert text(f'<article><h1>t</h1><div class="{name}">{article}</div></article>') == ["t"] + ["a"] * 60
    teaser = f"<article>{said('t', 5)}</article>"  # a wrapper beside another article
    assert text(f'<div class="has-sidebar"><article>{article}</article></div>{teaser}').count("a") == 60
    assert text(f'{teaser}<div class="has-sidebar">{article}</div>').count("a") == 60
    for inner in (article, f"<article>{article}</article>", f'<article class="comments-open">{article}</article>'):  # a whole-page form
        assert text(f'<form id="aspnetForm"><input name=v><select><option>o</select>{inner}</form>') == ["a"] * 60
    # what is not the article stays out, also when it is long
    assert text(f'<article>{article}</article><section class="comments">{said("c", 200)}</section>') == ["a"] * 60
    assert text(f'<article>{article}<section class="comments">{said("c", 200)}</section></article>') == ["a"] * 60
    assert text(f'<article>{article}</article>' + f'<article class="comment">{said("c", 50)}</article>' * 3) == ["a"] * 60
    wrapped = f'<article>{article}</article><section class="comments">{said("c", 90)}</section>'
    assert text(f'<div class="has-sidebar">{wrapped}</div>') == ["a"] * 60
    assert text(f'<article>{article}<form>{said("f", 20)}</form></article>') == ["a"] * 60


def test_words_of_an_article_stay():
    said = "<p>" + " ".join(["a"] * 40) + "</p>"
    for inner in ('<div class="warning">k k</div>', '<div class="search-results-explained">k k</div>', '<blockquote class="social-quote">k k</blockquote>',
                  '<div class="privacy">k k</div>', "<footer>k k</footer>", '<div role="alert">k <b id=notice>k</b></div>'):
        for page in (f"<article>{said}{inner}{said}</article>", f"<main>{said}{inner}</main>"):
            assert html_text.main_text(f"<body>{page}<footer>us</footer></body>", html_text.Weights()).split().count("k") == 2, inner
    # without its end tag an article doesn't own the page's footer
    assert html_text.main_text(f"<body><article>{said}<footer>us</footer></body>", html_text.Weights()).split() == ["a"] * 40


def test_attributes_of_tags():
    text = lambda page: html_text.main_text(page, html_text.Weights()).split()
    assert text("<p>one two three</p><p data-x=it's>hello there</p><p>more</p>") == "one two three hello there more".split()
    assert text("<article><p>one <a href=x title=don't>two</a> three</p><p>four</p></article>") == "one two three four".split()
    assert text("<p>a<b title='>' x=\"'>\">b</b>c<br/>d<img alt=y/>e</p><p class = ad >no</p>") == ["abc", "de"]
    tag = "x = 1 CLASS=a'b id = \"c d\" role='e' class=z/>"
    assert html_text.attributes(tag + "rest>", 0) == ({"class": "a'b", "id": "c d", "role": "e"}, False, len(tag))
    assert html_text.attributes(" / >", 0) == ({}, True, 4) and html_text.attributes(" a=\"b", 0) == ({}, False, 5)


def test_deep_pages_take_linear_time():
    pages = ["<div>" * 16_000 + "word " * 50, '<div class="widget">' * 16_000 + "word " * 50, "<article>" * 8000 + "w " * 9,
             '<article class="ad">x</article>' * 5000, '<div class="ad"><article>w w</article></div>' * 5000, "<" * 50_000, "<p " + "a=" * 40_000]
    for page in pages:
        began = time.process_time()
        html_text.main_text(page, html_text.Weights())
        assert time.process_time() - began < 3, page[:30]  # a quarter of a second here; quadratic work takes half a minute


def test_best_region_is_the_maximum():
    rng = random.Random(2)
    weights = html_text.Weights({"p": 1.5, "li": -1.0}, {"p": -2.0, "a": -0.5})
    for _ in range(200):
        found = [rng.choice([html_text.Token("text", rng.choice(["p", "li"]), "w " * rng.randrange(4)),
                             html_text.Token("open", rng.choice(["p", "a"]))]) for _ in range(rng.randrange(12))]
        value = [len(t.text.split()) * weights.words[t.name] if t.kind == "text" else weights.tags[t.name] for t in found]
        a, b = html_text.best_region(found, weights)
        best = max([0.0] + [sum(value[i:j]) for i in range(len(value)) for j in range(i + 1, len(value) + 1)])
        assert sum(value[a:b]) == pytest.approx(best)


def test_pages(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    weights = html_text.train_weights(pages)
    assert weights.words["p"] > 0 and weights.tags["p"] < 0
    odd = spark.createDataFrame([(1, "u", None, "x"), (2, "u", "", "x"), (2, "u", PAGE, "x"), (None, None, "<p>a b</p>", "x")],
                                "page_id long, url string, html string, text string")
    got = html_text.extract_main_text(odd, weights=weights)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted((r.text, r.n_chars) for r in got.collect()) == sorted([("", 0), ("", 0), (MAIN, len(MAIN)), ("a b", 3)])
    assert html_text.extract_main_text(odd.limit(0)).collect() == []
    rows = html_text.extract_main_text(pages, weights=weights).join(pages.select("page_id", "html"), "page_id").collect()
    for r in rows:  # every word of the article, in order, and nothing else
        inner = re.search("<article>(.*?)(</article>|<footer|$)", r.html, re.S)[1]
        assert "".join(r.text.split()) == "".join(html_text.html.unescape(re.sub("<[^>]+>", " ", inner)).split())


# ------------------------------------------------------------- mixing
def brute_targets(sizes, weights=(3, 1, 2), share=1.5, most=2.0):
    names = sorted(sizes, key=lambda s: (s is None, s))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_, out = share * sum(sizes.values()), set(names), {}
    while open_:
        level = left / sum(w[s] for s in open_)
        over = {s for s in open_ if level * w[s] > most * sizes[s]}
        for s in over or open_:
            out[s] = most * sizes[s] if over else level * w[s]
        left -= sum(out[s] for s in over)
        open_ -= over or open_
    return out


def mix_docs(rng, n=300):
    names = ["a", "B", "é", "z", None, "tiny", ""]
    return [(i, None if rng.random() < 0.05 else " ".join(f"w{i}_{k}" for k in range(rng.choice([0, 1, 7, 60, 400]))),
             "tiny" if i == 4 else rng.choice(names[:5] + names[6:] + ["a"] * 6)) for i in range(n)]


def test_mix(spark):
    docs = mix_docs(random.Random(6))
    df = spark.createDataFrame([(*d, "c") for d in docs], "doc_id long, text string, source string, taken string")
    rows = mixing.mix_sources(df).collect()
    by = defaultdict(list)
    for r in rows:
        by[r.source].append(r)
    sizes = defaultdict(int)
    for _, t, s in docs:
        sizes[s] += len(words(t))
    want = brute_targets(dict(sizes))
    assert len(rows) == len(docs) and set(by) == set(sizes)
    for s, some in by.items():
        assert {r.source_size for r in some} == {sizes[s]}
        assert some[0].target == pytest.approx(want[s])
        assert abs(sum(r.taken for r in some) - want[s]) <= max(1, 2 * min(64, sizes[s] / 256))
        assert all(0 <= r.taken <= 2 * r.size for r in some)
    assert sorted(map(str, mixing.mix_sources(df.repartition(7)).collect())) == sorted(map(str, rows))
    # the mix itself holds exactly the words taken
    text = dict((i, t) for i, t, _ in docs)
    taken = Counter()
    mixed = mixing.mixed_documents(df)
    assert mixed.columns == df.columns
    for r in mixed.collect():
        got = words(r.text)
        assert not Counter(got) - Counter(words(text[r.doc_id])) and got
        taken[r.doc_id] += len(got)
    assert taken == Counter({r.id: r.taken for r in rows if r.taken})
    assert mixing.mix_sources(df.limit(0)).collect() == [] and mixing.mixed_documents(df.limit(0)).collect() == []
    # the blocks as drawn: shards of a set size, every slot once, and the same words
    blocks = mixing.mixed_blocks(df, shard_slots=100).collect()
    assert Counter({r.id: r.taken for r in rows if r.taken}) == sum((Counter({r.doc_id: r.n_words}) for r in blocks), Counter())
    assert all(len(words(r.text)) == r.n_words for r in blocks)
    held = defaultdict(dict)
    for r in blocks:
        held[r.shard].setdefault(r.slot, set()).add(r.source)
    last = max(held)
    assert set(held) == set(range(last + 1)) and all(len(one) == 1 for slots in held.values() for one in slots.values())
    assert all(set(slots) <= set(range(100)) and (len(slots) > 95 or shard == last) for shard, slots in held.items())


def test_mix_keeps_columns_of_any_name(spark):
    names = "_th _i _t _s _ranges _words _all _row _id _source id th source_size pass shard slot size c0 c1 block".split()
    rows = [(i, f"w{i} x y z " * 9, None if i % 3 else "s", *names) for i in range(20)]
    df = spark.createDataFrame(rows + rows[:3], "doc_id long, text string, source string, " + ", ".join(f"`{c}` string" for c in names))
    got = mixing.mixed_documents(df)
    assert got.columns == df.columns
    assert all(tuple(r)[3:] == tuple(names) for r in got.collect())
    assert mixing.mix_sources(df).count() == 20


def test_shard_counts_are_multinomial():
    slots, size = np.array([5000, 2500, 0, 500]), 100
    draws = [mixing.draw_counts(slots, size, 0, 80, seed) for seed in range(60)]
    for before, counts in draws:
        assert not before.any() and (counts.sum(axis=0) == slots).all() and (counts.sum(axis=1) == size).all()
    every = np.concatenate([c for _, c in draws])
    share = slots / slots.sum()
    plain = np.random.default_rng(1).multinomial(size, share, 4800)
    assert np.allclose(every.mean(axis=0), plain.mean(axis=0), atol=.5)
    # totals are held, so a count varies by 1 - size / slots less than a plain multinomial one
    assert np.allclose(every.std(axis=0), plain.std(axis=0), rtol=.06, atol=.05)
    assert np.corrcoef(every[:, 0], every[:, 1])[0, 1] == pytest.approx(np.corrcoef(plain[:, 0], plain[:, 1])[0, 1], abs=.06)
    for a in (0, 17, 79):  # any range of shards can be drawn alone
        before, counts = mixing.draw_counts(slots, size, a, a + 1, 5)
        assert (before == draws[5][1][:a].sum(axis=0)).all() and (counts[0] == draws[5][1][a]).all()
    before, counts = mixing.draw_counts(np.array([6 * 10**10, 3 * 10**10 + 5]), 10**10, 9, 10, 3)  # beyond exact draws
    assert counts.sum() == 5 and (before + counts[0] == [6 * 10**10, 3 * 10**10 + 5]).all()


def test_permutations_and_counts():
    for n in (1, 2, 3, 17, 1000):
        for key in (1, 2**63 + 5):
            out = mixing.permute(np.arange(n), np.full(n, n), np.full(n, key, np.uint64))
            assert sorted(out.tolist()) == list(range(n))
    whole = mixing.shard_counts(10_000, 37, 0, 37, 99)
    assert whole.sum() == 10_000 and whole[0] == 0 and whole[1:].std() > 0
    for a in range(37):  # any shard can be drawn alone
        before, count = mixing.shard_counts(10_000, 37, a, a + 1, 99)
        assert (before, count) == (whole[:a + 1].sum(), whole[a + 1])


# ------------------------------------------------------------- packing
def test_first_fit_decreasing_matches_plain_scan():
    rng = np.random.default_rng(4)
    for n in (0, 1, 2, 50, 333):
        lengths = rng.integers(1, 101, n)
        bins, offsets, count = packing.first_fit_decreasing(lengths, 100)
        room, want = [], {}
        for i in np.argsort(-lengths, kind="stable"):
            b = next((b for b, r in enumerate(room) if r >= lengths[i]), len(room))
            if b == len(room):
                room.append(100)
            want[i] = (b, 100 - room[b])
            room[b] -= lengths[i]
        assert {i: (bins[i], offsets[i]) for i in range(n)} == want and count == len(room)


def check_packing(rows, docs):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    plain.encode_special_tokens = True
    ids = [plain.encode(t or "", add_special_tokens=False).ids + [0] for _, t in docs]
    frame = pd.DataFrame([r.asDict() for r in rows])
    for _, some in frame.groupby("sequence_id"):
        some = some.sort_values("offset")
        assert some.offset.tolist() == [0, *some.length.cumsum().tolist()[:-1]] and some.length.sum() <= 1024
    got = Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rows)
    want = Counter((i, a, len(x[a:a + 1024]), zlib.crc32(np.array(x[a:a + 1024], "<u4").tobytes()), len(x))
                   for (i, _), x in zip(docs, ids) for a in range(0, len(x), 1024))
    assert got == want
    return frame


def test_packing(spark, sf_dir):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    odd = [(1, None), (2, ""), (3, "<|endoftext|> it's"), (None, "x y" * 3000), (5, " \n\n é日本 " * 50), (5, "a"), (5, "a"), (7, "z" * 9000)]
    df = spark.createDataFrame([(*d, "c") for d in odd], "doc_id long, text string, start string")
    check_packing(packing.pack_documents(df, path, group_docs=3).collect(), odd)
    assert packing.pack_documents(df.limit(0), path).collect() == []
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    frame = check_packing(packing.pack_documents(docs, path).collect(), [(r.doc_id, r.text) for r in docs.collect()])
    used = frame.groupby("sequence_id").length.sum()
    padding = sum(0 if n & (n - 1) == 0 else 1024 - n for n in used)
    assert padding < 0.05 * used.sum()
