"""Main text by the maximum-scoring subsequence.

A page is a sequence of words and tags. Words score above zero where they stand in plain blocks and below zero in
links; tags score below zero, and more so with a class, id or role that stands outside of content. Boilerplate (menus,
headers, footers, sidebars, notices, adverts, forms, comments, known by element or by the words of class, id and role) is
cut out and scores nothing. The weights are log ratios learned from labelled pages: how often a tag, a name, or a word in
a block of some kind, stands inside the labelled content and outside. One linear scan finds the contiguous run with the
highest sum; where an end of it lies in an article or main element, it goes on to that element's end if the sum stays
above zero. Its blocks, without what is cut out, are the text.

Pages that mark their content (article or main) label themselves; at most max_pages of them (smallest hash of the id)
are learned from, added to one prior count each, so that any page can be scored, labelled or not.

Character references are decoded, white space in a block becomes one space, blocks are joined by an empty line. Null
pages are empty, and empty or wordless pages give the empty text. Unclosed elements and tags cut off at the end of a
page count as markup. Elements may be nested to any depth. A form around a page's structure is no boilerplate, an article
that is a reader's comment is.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.cluster import ship

MAX_PAGES = 1000
#: Keys of weights, the most frequent ones.
MAX_KEYS = 4096
RAW = "script|style|noscript|template|svg|iframe|object|canvas|title|select|textarea|button|math|audio|video"
_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({RAW})\b[^>]*?(?:/>|>.*?(?:</\1\s*>|\Z))|<(/?)([a-z][a-z0-9:-]*)((?:[^<>\"'=]|=\s*\"[^\"]*+\"|=\s*'[^']*+'|=|[\"'])*+)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)|<[a-z][^<>]*(?:>|\Z)",
    re.S | re.I,
)
_HINT = re.compile(r"(?<![\w-])(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_VALUE = re.compile(r"=\s*(?:\"[^\"]*\"|'[^']*'|[^\s\"'>]+)")
_HIDDEN = re.compile(r"(?<![\w-])hidden(?![\w-])", re.I)
_UNSEEN = re.compile(r"(?<![\w-])(?:aria-hidden\s*=\s*[\"']?true|style\s*=\s*(?:\"[^\"]*|'[^']*|[^\s\"'>]*)display\s*:\s*none)", re.I)
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
#: Elements that keep what is inside them together until they are closed.
SCOPES = frozenset("nav header footer aside form dialog menu section div article main body ul ol dl table figure blockquote fieldset details a".split())
DROPPED = frozenset("nav header footer aside form dialog menu fieldset".split())
#: Words in class, id and role of boilerplate.
HINTS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer gdpr header masthead menu menubar modal nav navbar navigation "
    "newsletter notice notices overlay pagination popup promo promoted promotion related replies reply respond share sharing sidebar signup social sponsor sponsored subscribe toolbar widget widgets".split()
)
#: A name that begins with a hint and ends with one of these is of boilerplate too.
PARTS = frozenset("slot unit item items link links list bar box area".split())
#: Words before a hint that tell of the page's layout.
LAYOUT = frozenset("has with no without is hide show layout".split())
CONTENT = frozenset("article main".split())
#: Words of class, id and role of readers' comments, which may be articles.
COMMENTS = frozenset("comment comments disqus replies reply respond".split())
#: A form that holds one of these wraps a page: it is no form of the page.
STRUCTURE = frozenset("article main nav header footer section aside".split())


def _names(attributes: str) -> list[str]:
    """The words of class, id and role."""
    return [name for m in _HINT.finditer(attributes) for name in (m[1] or m[2] or m[3] or "").lower().split()]


def _hinted(name: str) -> bool:
    """Whether a class, id or role is a hint, ends with one, or begins with one and ends with a part of one."""
    words = [w for w in re.split(r"[^a-z0-9]+", name) if w]
    if not words or LAYOUT.intersection(words[:-1]) or ("header" in words and {"article", "entry", "post"}.intersection(words)):
        return False
    return words[-1] in HINTS or (len(words) == 2 and words[0] in HINTS and words[1] in PARTS)


def _comment(name: str) -> bool:
    return _hinted(name) and bool(COMMENTS.intersection(re.split(r"[^a-z0-9]+", name)))


def _boilerplate(tag: str, attributes: str) -> bool:
    if tag in DROPPED:
        return True
    if not attributes or tag == "body":
        return False
    of_tag = _comment if tag in CONTENT else _hinted
    if any(map(of_tag, _names(attributes))):
        return True
    return bool(_HIDDEN.search(_VALUE.sub("= ", attributes)) or _UNSEEN.search(attributes))


def _wrappers(source: str) -> set[int]:
    """Numbers, in page order, of the forms that wrap a page's structure."""
    out, open_, n = set(), [], 0
    if "<form" in source.lower():
        for m in _TOKEN.finditer(source):
            tag = (m[3] or "").lower()
            if tag == "form":
                if m[2] != "/":
                    open_.append(n)
                    n += 1
                elif open_:
                    open_.pop()
            elif tag in STRUCTURE and m[2] != "/":
                out.update(open_)
                open_ = [-1] * len(open_)  # these are known
    return out


class Page:
    """Tokens of a page: (key, text, block, dropped, labelled). key: a tag with + or -, a name of a tag with a point, or the
    kind of a word's block; text: null for tags and names."""

    def __init__(self, source: str):
        self.tokens: list[tuple[str, str | None, int, bool, bool]] = []
        self.labelled = False
        stack: list[tuple[str, bool, bool]] = []
        block, kind, at = 0, "body", 0
        depth: Counter = Counter()  # open elements of each tag
        wrappers, forms = _wrappers(source), 0
        for m in _TOKEN.finditer(source):
            dropped = bool(stack) and stack[-1][1]
            inside = bool(stack) and stack[-1][2]
            self._text(source[at : m.start()], kind, block, dropped, inside, stack)
            at = m.end()
            tag = (m[3] or "").lower()
            if not tag:
                continue
            if tag == "br":
                self.tokens.append((f"word {kind}", " ", block, dropped, inside))
                continue
            close = m[2] == "/"
            if tag not in INLINE:
                block += 1
                kind = "body" if close else tag
            if tag in SCOPES:
                if not close:
                    plain = tag == "form" and forms in wrappers
                    forms += tag == "form"
                    gone = dropped or (not plain and _boilerplate(tag, m[4] or ""))
                    content = tag in CONTENT and not gone
                    self.labelled |= content
                    stack.append((tag, gone, inside or content))
                    depth[tag] += 1
                elif depth[tag]:
                    while True:
                        last = stack.pop()[0]
                        depth[last] -= 1
                        if last == tag:
                            break
            elif not close and tag not in INLINE and m[4] and _boilerplate(tag, m[4]):
                kind = "boilerplate"
            now = bool(stack) and stack[-1][2]
            gone = dropped or kind == "boilerplate" or (bool(stack) and stack[-1][1])
            self.tokens.append((f"{'-' if close else '+'}{tag}", None, block, gone, inside or now))
            if m[4] and not close and tag not in INLINE:
                self.tokens += [(f".{name}", None, block, gone, inside or now) for name in dict.fromkeys(_names(m[4]))]
        self._text(source[at:], kind, block, bool(stack) and stack[-1][1], bool(stack) and stack[-1][2], stack)

    def _text(self, raw: str, kind: str, block: int, dropped: bool, inside: bool, stack) -> None:
        if raw:
            dropped = dropped or kind == "boilerplate"
            link = any(s[0] == "a" for s in stack[-2:])
            name = "word boilerplate" if dropped else f"word {kind}{' link' if link else ''}"
            self.tokens.append((name, html.unescape(raw), block, dropped, inside))


def counts(source: str) -> tuple[Counter, Counter] | None:
    """What stands inside and outside the labelled content; null for pages without a label."""
    page = Page(source)
    if not page.labelled:
        return None
    inner, outer = Counter(), Counter()
    for key, text, _, dropped, inside in page.tokens:
        (inner if inside and not dropped else outer)[key] += 1 if text is None else len(text.split())
    return inner, outer


class Weights:
    """Scores from counts. Prior: a word is as likely inside as outside, a tag is likelier outside."""

    def __init__(self, inner: dict[str, int], outer: dict[str, int]):
        self.inner, self.outer = dict(inner), dict(outer)
        self.words_in = sum(n for k, n in self.inner.items() if k.startswith("word"))
        self.words_out = sum(n for k, n in self.outer.items() if k.startswith("word"))

    def of(self, key: str) -> float:
        a, b = self.inner.get(key, 0), self.outer.get(key, 0)
        if key.startswith("."):
            return -min(12.0, max(0.0, 2 * math.log((b + 1) / (a + 1))))
        if key.startswith("word"):
            return min(2.0, max(0.1 if not key.endswith(" link") else -0.5, 0.5 + math.log((a + 1) / (b + 1)) / 4)) if not key.endswith(" link") else min(0.5, max(-0.5, math.log((a + 1) / (b + 1)) / 4))
        if key[1:] in INLINE:
            return -0.01
        return -min(4.0, max(0.01, 0.3 + math.log((b + 1) / (a + 1))))


def best_run(scores: list[float]) -> tuple[int, int]:
    """First and end of the contiguous run with the highest sum above zero, the first such to end; (0, 0) if none."""
    best, best_range, run, begin = 0.0, (0, 0), 0.0, 0
    for i, score in enumerate(scores):
        run += score
        if run > best:
            best, best_range = run, (begin, i + 1)
        if run <= 0:
            run, begin = 0.0, i + 1
    return best_range


def main_text(source: str | None, weights: Weights) -> str:
    tokens = Page(source or "").tokens
    known: dict[str, float] = {}
    scores = []
    for key, text, _, dropped, _ in tokens:
        w = known.get(key)
        if w is None:
            w = known[key] = weights.of(key)
        scores.append(0.0 if dropped else w if text is None else w * len(text.split()))
    out: dict[int, list[str]] = {}
    first, last = best_run(scores)
    if last > first:  # whole blocks, and the whole of the content element that the run is in
        total, a, b = sum(scores[first:last]), first, last
        while a and tokens[a][4] and tokens[a - 1][4]:
            a -= 1
        while b < len(tokens) and tokens[b - 1][4] and tokens[b][4]:
            b += 1
        if total + sum(scores[a:first]) > 0:
            total, first = total + sum(scores[a:first]), a
        if total + sum(scores[last:b]) > 0:
            last = b
        one, end = tokens[first][2], tokens[last - 1][2]
        for _, text, block, dropped, _ in tokens:
            if text is not None and not dropped and one <= block <= end:
                out.setdefault(block, []).append(text)
    texts = (" ".join("".join(x).split()) for _, x in sorted(out.items()))
    return "\n\n".join(t for t in texts if t)


def _strings(column: pa.Array) -> Iterator[str]:
    for x in column.cast(pa.binary()):
        yield (x.as_py() or b"").decode("utf-8", "replace")


def _count_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    inner, outer = Counter(), Counter()
    for batch in batches:
        for source in _strings(batch.column(0)):
            if got := counts(source):
                inner.update(got[0])
                outer.update(got[1])
    keys = sorted({*inner, *outer})
    yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array([inner[k] for k in keys], pa.int64()), pa.array([outer[k] for k in keys], pa.int64())], ["key", "inside", "outside"])


def learn(pages: DataFrame, html_col: str = "html", id_col: str = "page_id", max_pages: int = MAX_PAGES) -> Weights:
    """Weights from at most max_pages pages that mark their content."""
    ship(pages.sparkSession)
    marked = pages.where(F.col(html_col).rlike("(?i)<(article|main)[\\s>]")).select(F.col(id_col).alias("__id"), F.xxhash64(id_col).alias("order"))
    chosen = marked.orderBy("order", "__id").limit(max_pages).select("__id").distinct()
    sample = pages.join(F.broadcast(chosen), F.col(id_col) == F.col("__id"), "left_semi").select(F.col(html_col).alias("html"))
    rows = sample.mapInArrow(_count_rows, "key string, inside long, outside long").groupBy("key").agg(F.sum("inside").alias("inside"), F.sum("outside").alias("outside"))
    rows = rows.orderBy(F.desc(F.col("inside") + F.col("outside")), "key").limit(MAX_KEYS).collect()
    return Weights({r.key: r.inside for r in rows}, {r.key: r.outside for r in rows})


def _text_rows(weights):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                texts = [main_text(s, weights.value) for s in _strings(batch.column(2))]
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return run


def extracted(pages: DataFrame, weights: Weights | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text and n_chars of every row of pages."""
    ship(pages.sparkSession)
    weights = pages.sparkSession.sparkContext.broadcast(weights or learn(pages, html_col, id_col))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).alias("html"))
    return rows.mapInArrow(_text_rows(weights), "page_id long, url string, text string, n_chars long")
