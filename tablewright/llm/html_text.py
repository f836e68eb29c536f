"""HTML extraction by maximum-scoring subsequence.

A page becomes a sequence of words and tags.  Elements that never belong to an
article (scripts, navigation) are cut out first, and so are forms and elements
whose class, id or role says so, unless they hold what is left of the page
(see ``judge``).  Words score by the element they stand in, tags score
negative, and one linear scan finds the contiguous region with the highest
total.  The weights are log-odds learned from labelled pages: pages whose
author marked the article (``article`` or ``main``), words inside against words
outside.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

# Element kinds of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template svg math".split())
CUT = frozenset("head nav footer aside form button select option dialog menu object canvas audio video map".split()) | RAW
BLOCK = frozenset("""address article blockquote body caption center dd details div dl dt fieldset figcaption figure h1 h2 h3 h4 h5
h6 header hr html li main ol p pre section summary table tbody td tfoot th thead tr ul""".split())
# a start tag of the first kind ends an open element of the second kind
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
          "option": {"option"}}
# Words of class, id and role that mark what is not the article.
MARKS = frozenset("""ad ads adv advert adverts advertisement advertising adbox adslot banner breadcrumb breadcrumbs comment comments
commentlist consent contentinfo cookie cookies copyright discussion disqus donate footer gdpr header login masthead menu modal nav
navbar navigation newsletter notice notices notification overlay pagination pager paywall popup privacy promo promotion promoted
promos related recommended recommendations replies reply respond responses search share sharing sidebar signup skip social sponsor
sponsored subscribe subscription tagcloud teaser toolbar topbar warning widget widgets alert announcement complementary""".split())
ARTICLE = frozenset({"article", "main"})

# Of those, what an article itself is left without.
ARTICLE_MARKS = frozenset("""ad ads adv advert adverts advertisement advertising adbox adslot breadcrumb breadcrumbs comment comments
commentlist cookie cookies disqus menu nav navbar navigation newsletter pager pagination promo promotion promotions promos recommended related
share sharing sidebar signup sponsor sponsored subscribe subscription widget widgets""".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(.*?)(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)", re.S)
# a name, with a value in quotes or one without (in which a quote is a character like others)
_ATTRIBUTE = re.compile(r"[\s/]*(?:([^\s/>=]+)(?:\s*=\s*(?:\"([^\"]*)(?:\"|\Z)|'([^']*)(?:'|\Z)|([^\s>]*)))?|=)")
_TAG_END = re.compile(r"[\s/]*(?:>|\Z)")
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


@dataclass
class Weights:
    """Score of a word by the block element it stands in, and of a tag by its name."""

    words: dict[str, float] = field(default_factory=dict)
    tags: dict[str, float] = field(default_factory=dict)
    word: float = 1.0    # elements that were not seen
    tag: float = -0.25


def attributes(page: str, at: int) -> tuple[dict[str, str], bool, int]:
    """Class, id and role of the tag whose name ends at ``at``, whether it ends with a slash, and where it ends."""
    found: dict[str, str] = {}
    while (end := _TAG_END.match(page, at)) is None:
        m = _ATTRIBUTE.match(page, at)
        if m[1] and (name := m[1].lower()) in ("class", "id", "role") and name not in found:
            found[name] = m[2] or m[3] or m[4] or ""
        at = m.end()
    return found, "/" in end[0], end.end()


def is_marked(values: dict[str, str], article: bool) -> bool:
    """Whether class, id or role names something that is not the article (inside one: that an article is left without)."""
    return any(word.lower() in (ARTICLE_MARKS if article else MARKS) for value in values.values() for word in _NAME.findall(value))


@dataclass
class Token:
    kind: str            # "text", "open" or "close"
    name: str            # tag, or the block element around a text
    text: str = ""
    inside: bool = False  # in an element marked as the article
    against: bool = False  # in an article whose class names something else, beside a larger one


@dataclass
class Part:
    """A form, an element marked as boilerplate, or an outermost article."""

    parent: int          # the part around it, -1 for none
    article: bool
    marked: bool
    words: int = 0

    @property
    def soft(self) -> bool:
        return self.marked and not self.article


def judge(parts: list[Part], outside: int) -> tuple[set[int], set[int]]:
    """The parts that are cut, and those whose words score negative; ``words`` of each part are its own before.

    ``outside`` are the words in no part.  An article is not cut for its own
    class, but its words count against it beside an unmarked article as large.
    Other parts are cut, except those around an unmarked article larger than
    every article that isn't in such a part, and those with more than half of
    the page's words, and more than four times as many as the largest article
    that stays without them.
    """
    n = len(parts)
    words, below = [p.words for p in parts], [p.words for p in parts]
    for i in range(n - 1, -1, -1):  # a part stands before those in it
        if parts[i].parent >= 0:
            words[parts[i].parent] += words[i]
    total = outside + sum(w for w, p in zip(words, parts) if p.parent < 0)
    spared: set[int] = set()

    def cuts() -> list[bool]:
        out: list[bool] = []
        for i, p in enumerate(parts):
            out.append((p.parent >= 0 and out[p.parent]) or (p.soft and i not in spared))
        return out

    articles = [i for i, p in enumerate(parts) if p.article]
    cut = cuts()
    hidden = [i for i in articles if cut[i] and not parts[i].marked]
    if hidden:
        largest = max(hidden, key=lambda i: words[i])
        if all(words[largest] > words[i] for i in articles if not cut[i]):
            i = largest
            while (i := parts[i].parent) >= 0:
                if parts[i].soft:
                    spared.add(i)
            cut = cuts()
    # words that stay in each part, and the largest article that stays in it, when the parts cut inside it go
    most = [0] * n
    for i in range(n - 1, -1, -1):
        if parts[i].article:
            most[i] = max(most[i], below[i])
        up = parts[i].parent
        if up >= 0 and not (parts[i].soft and i not in spared):
            below[up] += below[i]
            most[up] = max(most[up], most[i])
    stays = max((m for m, p, i in zip(most, parts, range(n)) if p.parent < 0 and not (p.soft and i not in spared)), default=0)
    for i, p in enumerate(parts):  # parts with more than half of the words stand in each other, the outer ones first
        if p.soft and i not in spared and 2 * words[i] > total and (p.parent < 0 or p.parent in spared or not cut[p.parent]):
            if words[i] <= 4 * stays:
                break
            spared.add(i)
            cut[i] = False
            stays = max(stays, most[i])
    if spared:
        cut = cuts()
    # marked articles beside an unmarked one as large, which neither holds them nor stands in them
    plain = [i for i in articles if not cut[i] and not parts[i].marked]
    top = sorted(plain, key=lambda i: -words[i])
    ends = list(range(1, n + 1))  # the part after the last one inside each
    for i in range(n - 1, -1, -1):
        if parts[i].parent >= 0:
            ends[parts[i].parent] = max(ends[parts[i].parent], ends[i])
    against: set[int] = set()
    for i, p in enumerate(parts):
        if p.parent in against:
            against.add(i)
        elif p.article and p.marked and not cut[i]:
            # articles that stand in this one or hold it come first at most once each on the way
            other = next((j for j in top if not (i <= j < ends[i] or j <= i < ends[j])), None)
            if other is not None and words[other] >= words[i]:
                against.add(i)
    return {i for i in range(n) if cut[i]}, against


def tokens(page: str) -> list[Token]:
    """Tags and texts of ``page`` without the elements that are cut out.

    End tags without a start are ignored; a missing end tag ends with an
    enclosing element that ends.  Forms and elements marked by class, id or
    role are judged when the whole page is read; a footer inside an article
    that has its end tag belongs to it.  Each tag costs the same however deep
    it stands.
    """
    out: list[Token] = []
    place: list[int] = []  # the innermost part around each token, -1 for none
    parts: list[Part] = []
    stack: list[tuple[str, bool, int, str]] = []  # open elements, whether each starts a cut, its innermost part and block
    opened: dict[str, list[int]] = {}  # places in the stack of each name
    solid: list[int] = []  # and of blocks and elements that are cut
    footers: list[tuple[int, int]] = []  # footers of open articles: place in the stack, part
    cut = depth = at = 0

    def add(token: Token) -> None:
        out.append(token)
        place.append(stack[-1][2] if stack else -1)

    def text(raw: str) -> None:
        if not cut and raw:
            add(Token("text", stack[-1][3] if stack else "body", html.unescape(raw), depth > 0))

    def close(upto: int) -> None:
        nonlocal cut, depth
        while len(stack) > upto:
            name, starts, _, _ = stack[-1]
            if not cut:
                add(Token("close", name, "", depth > 0))
            stack.pop()
            opened[name].pop()
            if solid and solid[-1] == len(stack):
                solid.pop()
            cut -= starts
            depth -= name in ARTICLE

    def last(name: str) -> int:
        places = opened.get(name)
        return places[-1] if places else -1

    while at < len(page):
        m = _TOKEN.search(page, at)
        if m is None:
            text(page[at:])
            break
        text(page[at:m.start()])
        at = m.end()
        name = (m[3] or "").lower()
        if m[1] is not None:
            text(html.escape(m[1], False))
        if not name:
            continue
        values, slash, at = attributes(page, at)
        if m[2]:
            found = last(name)
            if found >= 0:
                if name in ARTICLE:
                    while footers and footers[-1][0] > found:
                        parts[footers.pop()[1]].marked = False
                close(found)
            continue
        if name in CLOSES or name == "p":
            # an element of the same list, or a paragraph, ends where the next begins
            found = max(last(n) for n in CLOSES.get(name, {"p"}))
            if found >= 0 and not (solid and solid[-1] > found):
                close(found)
        elif name in BLOCK:
            found = last("p")
            if found >= 0 and not (solid and solid[-1] > found):
                close(found)
        article = depth > 0
        form = name == "form"
        own_footer = name == "footer" and article
        starts = (name in CUT and not form and not own_footer) or (name == "header" and not article)
        marked = form or own_footer or (name not in ("html", "body") and is_marked(values, article))
        alone = name in VOID or slash
        outermost = name in ARTICLE and last("article") < 0 and last(name) < 0
        part = stack[-1][2] if stack else -1
        if not cut and not starts and not alone and (marked or outermost):
            parts.append(Part(part, outermost, marked))
            part = len(parts) - 1
            if own_footer:
                footers.append((len(stack), part))
        if not cut and not starts and not (alone and marked):
            out.append(Token("open", name, "", article or name in ARTICLE))
            place.append(part)
        if alone:
            continue
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}\b[^>]*(?:>|\Z)", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        opened.setdefault(name, []).append(len(stack))
        if name in BLOCK or name in CUT:
            solid.append(len(stack))
        stack.append((name, starts, part, name if name in BLOCK else stack[-1][3] if stack else "body"))
        cut += starts
        depth += name in ARTICLE
    if not any(p.marked for p in parts):
        return out
    outside = 0
    for t, i in zip(out, place):
        if t.kind == "text":
            n = len(t.text.split())
            if i >= 0:
                parts[i].words += n
            else:
                outside += n
    gone, against = judge(parts, outside)
    for t, i in zip(out, place):
        if i in against:
            t.inside, t.against = False, True
    return [t for t, i in zip(out, place) if i not in gone]


def best_region(found: list[Token], weights: Weights) -> tuple[int, int]:
    """First and last + 1 token of the contiguous region with the highest total score (0, 0 if none is positive)."""
    best, total, start, region = 0.0, 0.0, 0, (0, 0)
    for i, t in enumerate(found):
        if t.kind == "text":
            n = len(t.text.split())
            score = weights.words.get(t.name, weights.word)
            total += n * (min(score, -1.0) if t.against else score)
        else:
            total += weights.tags.get(t.name, weights.tag)
        if total <= 0:
            total, start = 0.0, i + 1
        elif total > best:
            best, region = total, (start, i + 1)
    return region


def main_text(page: str | None, weights: Weights) -> str:
    """Blocks of the best region in page order, joined by an empty line."""
    found = tokens(page or "")
    a, b = best_region(found, weights)
    blocks: list[str] = []
    part: list[str] = []

    def end_block() -> None:
        joined = " ".join("".join(part).split())
        if joined:
            blocks.append(joined)
        part.clear()

    for t in found[a:b]:
        if t.kind == "text":
            part.append(t.text)
        elif t.name in BLOCK:
            end_block()
        elif t.name == "br":
            part.append(" ")
    end_block()
    return "\n\n".join(blocks)


# ------------------------------------------------------------- weights from labelled pages
def _count_page(page: str) -> Counter:
    """(kind, name, inside) counts of a page whose author marked the article; empty for others."""
    found = tokens(page)
    if not any(t.inside for t in found):
        return Counter()
    counts: Counter = Counter()
    for t in found:
        counts["word" if t.kind == "text" else "tag", t.name, t.inside] += len(t.text.split()) if t.kind == "text" else 1
    return counts


def _count_pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts: Counter = Counter()
        for page in batch.column(0).to_pylist():
            counts.update(_count_page(page or ""))
        rows = [(*k, n) for k, n in counts.items() if n]
        yield pa.record_batch([pa.array(c, t) for c, t in zip(
            list(zip(*rows)) if rows else [[]] * 4, (pa.string(), pa.string(), pa.bool_(), pa.int64()))],
            names=["kind", "name", "inside", "n"])


def weights_from(rows: list[tuple[str, str, bool, int]], least_share: float = 1e-4) -> Weights:
    """Log-odds of words (limited to +-3) and costs of tags from counts inside and outside articles."""
    out = Weights()
    for kind, place in (("word", out.words), ("tag", out.tags)):
        total = sum(n for k, _, _, n in rows if k == kind)
        for name in {r[1] for r in rows if r[0] == kind}:
            inside, outside = (sum(n for k, m, i, n in rows if (k, m, i) == (kind, name, flag)) for flag in (True, False))
            if inside + outside < least_share * total:
                continue
            odds = math.log((inside + 1) / (outside + 1))
            place[name] = max(-3.0, min(3.0, odds)) if kind == "word" else -0.25 - max(0.0, min(3.0, -odds))
    return out


def train_weights(pages: DataFrame, html_col: str = "html", id_col: str = "page_id", fit_pages: int = 2000,
                  fit_names: int = 2000) -> Weights:
    """Weights from at most ``fit_pages`` pages, those with the smallest hashes of their ids, and their ``fit_names`` most
    frequent counts (pages can make up tag names; those left out score as unseen ones)."""
    picked = (pages.where(F.col(html_col).isNotNull()).select(F.col(id_col).alias("_id")).distinct()
              .orderBy(F.xxhash64(F.col("_id").cast("string")), "_id").limit(fit_pages))
    counts = (pages.join(F.broadcast(picked), F.col(id_col) == F.col("_id")).select(html_col)
              .mapInArrow(_count_pages, "kind string, name string, inside boolean, n long")
              .groupBy("kind", "name", "inside").agg(F.sum("n").alias("n"))
              .orderBy(F.desc("n"), "kind", "name", "inside").limit(fit_names).collect())
    return weights_from([tuple(r) for r in counts])


def extract_main_text(pages: DataFrame, html_col: str = "html", id_col: str = "page_id",
                      weights: Weights | None = None) -> DataFrame:
    """All columns of ``pages`` but ``html_col``, plus ``text`` and ``n_chars`` (input columns of those names are replaced).

    A null or empty page, or one without a positive region, has an empty text.
    Repeated rows give repeated rows, also in the fitted counts; rows with a
    null id are extracted but not fitted on; an empty table gives no rows.
    """
    weights = weights or train_weights(pages, html_col, id_col)
    pages = pages.drop("text", "n_chars")
    fields = StructType([*pages.drop(html_col).schema.fields, StructField("text", StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(html_col)
            texts = [main_text(p.as_py(), weights) for p in batch.column(at)]
            names = [n for n in batch.schema.names if n != html_col]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(texts, pa.string())],
                                             names=[*names, "text"])

    return pages.mapInArrow(run, fields).withColumn("n_chars", F.length("text").cast("long"))
