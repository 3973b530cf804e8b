"""WARC round trips, main text and URL filters."""

import base64
import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from tickloom.llm import maintext, queries, urlfilter, warc

SF = "/root/testdata/sf0.01"
PAGES = "page_id long, url string, html string, digest string, id long, payload string, refers_to long"


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "d", 3, "p", 4) for i, u, h in rows], PAGES)


def sha(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


ROWS = [
    (1, "http://a/", "same"), (2, "http://b/", "same"), (9, "http://c/", "same"), (3, "http://d/\r\nX: y", "other"), (4, None, None), (5, "http://e/", ""), (6, "u", "é\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n\r\n\r\n"),
    (7, "v", "\r\n\r\n"), (8, "w", "x" * 300_000), (10, "", "line\nline\n"), (None, "n", "same"), (11, "q", "twice"), (11, "q", "twice"),
]


def test_archive_round_trip(spark):
    got = warc.archive_pages(pages(spark, ROWS)).collect()
    assert len(got) == len(ROWS)
    want = []
    for i, _, h in ROWS:
        top = max(j for j, _, g in ROWS if (g or "") == (h or "") and j is not None)
        want.append((i, len((h or "").encode()), sha(h), "response" if i == top else "revisit", None if i == top else top))
    key = lambda t: str(t)
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_archive_holds_each_payload_once(spark, tmp_path):
    warc.write(warc.records(pages(spark, ROWS)), f"file://{tmp_path}/w")
    back = warc.read(spark, f"file://{tmp_path}/w").toPandas()
    full = back[back.record_type == "response"]
    assert sorted(map(bytes, full.payload)) == sorted((h or "").encode() for h in ["same", "other", "", ROWS[6][2], ROWS[7][2], ROWS[8][2], "line\nline\n", "twice", "twice"])
    assert back[back.id == 3].url.item() == "http://d/%0D%0AX: y"


def test_small_payloads_stay_responses(spark):
    got = warc.archive_pages(pages(spark, ROWS), min_bytes=5).collect()
    assert {r.record_type for r in got if r.payload_bytes < 5} == {"response"}


def test_long_pages_and_a_hot_response(spark, tmp_path):
    """Pages of many megabytes stand in files of their own; thousands of copies refer to one response."""
    long = [(10_000 + i, f"http://l/{i}", ("é" * 2_000_000 if i % 2 else "<p>x " * 1_000_000) + str(i // 4)) for i in range(12)]
    middle = [(20_000 + i, f"http://m/{i}", "m" * 200_000 + str(i)) for i in range(80)]
    hot = [(i, f"http://h/{i}", "copied page") for i in range(3000)]
    rows = [(*r, 9, "d") for r in [*long, *middle, *hot]]
    d = spark.createDataFrame(rows, "page_id long, url string, html string, n_bytes int, digest string")
    got = {r.page_id: tuple(r)[1:] for r in warc.archive_pages(d, f"file://{tmp_path}/w").collect()}
    top = {}
    for i, _, h in [*long, *middle, *hot]:
        top[h] = max(top.get(h, -1), i)
    assert got == {i: (len(h.encode()), sha(h), *(("response", None) if top[h] == i else ("revisit", top[h]))) for i, _, h in [*long, *middle, *hot]}
    back = warc.read(spark, f"file://{tmp_path}/w").where("id >= 10000 and record_type = 'response'").select("id", "n_bytes").collect()
    assert len(back) == 80 + len({h for *_, h in long})
    sizes = {}
    for f in (tmp_path / "w").rglob("*.gz"):
        sizes.setdefault(f.parent.name, []).append(sum(len(p) for _, p in warc.parse(__import__("gzip").open(f))))
    assert max(sizes["files=1"]) <= 64 << 20 and len(sizes["files=2"]) == 12


def test_archive_of_nothing(spark):
    assert warc.archive_pages(pages(spark, [])).count() == 0


def test_archive_of_given_pages(spark):
    rows = spark.read.parquet(f"{SF}/pages.parquet").collect()
    top = {}
    for r in rows:
        top[r.html] = max(top.get(r.html, -1), r.page_id)
    got = {r.page_id: tuple(r)[1:] for r in queries.QUERIES["op1_warc_revisits"](spark, SF).collect()}
    for r in rows:
        t = top[r.html]
        assert got[r.page_id] == (len(r.html.encode()), sha(r.html), *(("response", None) if t == r.page_id else ("revisit", t)))


@pytest.mark.parametrize("seed", range(30))
def test_best_run_is_the_best_of_all(seed):
    rng = random.Random(seed)
    scores = [rng.choice([-2.0, -1.0, -0.5, 0.0, 0.5, 1.0, 1.5]) for _ in range(rng.randrange(0, 40))]
    first, end = maintext.best_run(scores)
    runs = {(i, j): sum(scores[i:j]) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1)}
    most = max([0.0, *runs.values()])
    assert sum(scores[first:end]) == most
    assert end == min([j for (_, j), x in runs.items() if x == most], default=0) if most else (first, end) == (0, 0)


ARTICLE = "<article><h1>Ti&shy;tle</h1><p>First <b>bold</b>text &amp; more words of the\n article here.<br>Next line.<p>Second paragraph&nbsp;with enough words to count.</p><blockquote>Quoted words</blockquote></article>"
TEXT = "Ti\xadtle\n\nFirst boldtext & more words of the article here. Next line.\n\nSecond paragraph with enough words to count.\n\nQuoted words"


@pytest.mark.parametrize(
    "page",
    [
        f"<html><head><title>T</title><style>p{{}}</style></head><body><nav><ul><li><a href='/'>Home</a></li></ul></nav>{ARTICLE}<footer>&copy; x</footer></body></html>",
        f"<body><header><p>Site name and slogan words</p></header><div class='sidebar'><p>Side words here and more of them</p></div>{ARTICLE}<div id=comments><p>I think this is a reader comment</p></div>",
        ARTICLE.replace("</p><blockquote>", "</p><aside><p>Related words</p></aside><form><p>Sign up</p></form><script>var t='</p>'</script><!-- <p>no</p> --><div class=\"ad-box ad\">Buy it now</div><blockquote>"),
        f"<div class='cookie-notice'>We use cookies and more words about them</div><main>{ARTICLE}</main><p class='advert'>Buy these words</p>",
    ],
)
def test_main_text(spark, page):
    weights = maintext.learn(spark.read.parquet(f"{SF}/pages.parquet"))
    assert maintext.main_text(page, weights) == TEXT


def test_main_text_without_marks(spark):
    weights = maintext.learn(spark.read.parquet(f"{SF}/pages.parquet"))
    page = "<body><ul><li><a href=/a>One</a></li><li><a href=/b>Two</a></li></ul><div id=content><h2>Head of it</h2><p>Many words in this one paragraph of the page.</p><p>And some more of them.</p></div><ul><li><a href=/c>Three</a></li></ul>"
    assert maintext.main_text(page, weights) == "Head of it\n\nMany words in this one paragraph of the page.\n\nAnd some more of them."


def test_main_text_of_given_pages(spark):
    """The given pages mark their article: what stands there, block by block."""
    import html

    def plain(source):
        m = re.search(r"<article>(.*?)(</article>|$)", source, re.S)
        blocks = re.split(r"<[^>]*(?:>|$)", re.sub(r"<br>|</?b>", " ", m[1]))
        return "\n\n".join(t for t in (" ".join(html.unescape(b).split()) for b in blocks) if t)

    got = {r.page_id: (r.text, r.n_chars) for r in queries.QUERIES["op2_main_text"](spark, SF).collect()}
    for r in spark.read.parquet(f"{SF}/pages.parquet").collect():
        assert got[r.page_id] == (plain(r.html), len(plain(r.html)))


def test_main_text_of_odd_pages(spark):
    rows = [(1, None, None), (2, "u", ""), (3, "u", "<p"), (4, "u", "&lt;"), (5, "u", "<div>" * 20_000), (None, "u", "<p>a"), (6, "u", "<" * 50_000), (6, "u", '<a href="' + "x" * 50_000), (7, "u", "</p></div>")]
    got = maintext.extracted(pages(spark, rows)).collect()
    assert len(got) == len(rows)
    assert all(r.n_chars == len(r.text) for r in got)
    assert maintext.extracted(pages(spark, [])).count() == 0


def _regex(glob):
    return re.compile("".join({"*": "[^/]*", "**": ".*", "?": "."}.get(t, re.escape(t)) for t in re.findall(r"\*\*|\*|\?|[^*?]", glob)), re.S)


def test_automaton_equals_regular_expressions():
    import numpy as np

    rng = random.Random(3)
    globs = ["".join(rng.choice(["a", "b", "/", ".", "?", "*", "**"]) for _ in range(rng.randrange(0, 9))) for _ in range(120)]
    globs = [g.replace("***", "**") for g in globs]
    urls = ["".join(rng.choice("ab/.") for _ in range(rng.randrange(0, 14))) for _ in range(300)]
    raw = np.frombuffer("".join(urls).encode(), np.uint8)
    offs = np.concatenate([[0], np.cumsum([len(u) for u in urls])])
    machine = urlfilter.Automaton(globs)
    assert machine.n_words > 5
    got = machine.matches(raw, offs)
    want = [[bool(_regex(g).fullmatch(u)) for g in globs] for u in urls]
    assert got.tolist() == want


def test_url_rules(spark):
    rows = [
        (1, "HTTP://WWW.Example.ORG/es/x?y"), (2, "http://example.org"), (3, "http://notexample.org/es/"), (4, "http://a.com/fr/?q"), (5, "http://a.com/FR/"), (6, "http://evil.net/x.org/"), (7, None), (8, "no scheme"),
        (9, "x://://org/"), (10, "http://free-bets.net/"), (11, "http://b.com/de/org/"), (12, "http://org/"), (13, "http://example.org/en/12"), (14, "http://ÄB.org/" + "p" * 5000), (15, "http://casino.net#x"),
    ]
    got = {r.page_id: tuple(r)[1:] for r in urlfilter.judged(pages(spark, [(i, u, "") for i, u in rows])).collect()}
    assert got[1] == ("www.example.org", "/es/x", "example.org/es/", "block")
    assert got[2] == ("example.org", "", None, "allow")
    assert got[3] == ("notexample.org", "/es/", "org/", "allow")
    assert got[4][2:] == ("com/fr/", "allow") and got[5][2:] == (None, "allow")
    assert got[6] == ("evil.net", "/x.org/", None, "allow")
    assert got[7] == got[8] == ("", "", None, "allow")
    assert got[9] == ("", "", None, "allow") or got[9][0] in ("", ":")
    assert got[10][2:] == (None, "block") and got[11][2:] == ("com/de/", "block") and got[12][2:] == ("org/", "allow")
    assert got[13][2:] == ("example.org/en/1", "block") and got[14][0] == "Äb.org" and got[15] == ("casino.net", "", None, "block")
    assert urlfilter.judged(pages(spark, [])).count() == 0
    assert urlfilter.judged(pages(spark, [(1, None, ""), (1, None, "")]).withColumn("host", F.lit("h"))).count() == 2


def test_url_rules_of_tables(spark, monkeypatch):
    """Ties go to the first row in order, repeated and null rows do not count, and large tables are refused."""
    rules = spark.createDataFrame([("b.org", "/x", "block"), ("b.org", "/x", "allow"), ("b.org", "/x", "block"), ("org", "/xyz", "block"), (None, "/", "block"), ("c.net", "", "allow")], "host string, path string, verdict string")
    globs = spark.createDataFrame([("*spam**", 1), (None, 2), ("*spam**", 3), ("?.net/*", 4)], "glob string, n int")
    rows = [(1, "http://b.org/xyz", ""), (2, "http://a.org/xyz", ""), (3, "http://spam.c.net/", ""), (4, "http://spam.net/a", ""), (5, "http://d.net/a", ""), (6, "http://d.net/a/b", "")]
    got = {r.page_id: (r.rule, r.verdict) for r in urlfilter.judged(pages(spark, rows), rules, globs).collect()}
    assert got == {1: ("b.org/x", "allow"), 2: ("org/xyz", "block"), 3: ("c.net", "allow"), 4: (None, "block"), 5: (None, "block"), 6: (None, "allow")}
    monkeypatch.setattr(urlfilter, "MAX_BITS", 20)
    with pytest.raises(ValueError, match="characters of rules"):
        urlfilter.judged(pages(spark, rows), rules, globs)


BODY = "Many plain words stand in this paragraph, which is the content of the page."


@pytest.mark.parametrize(
    "page",
    [
        f'<body class="has-sidebar"><p>{BODY}</p></body>',
        f'<body class="home sidebar"><main class="with-sidebar"><p>{BODY}</p></main></body>',
        f'<body><article class="post comments-open"><p>{BODY}</p></article></body>',
        f'<body><article class="post related"><p>{BODY}</p></article></body>',
        f'<body><div class="overflow-hidden"><section class="no-sidebar content-sidebar-wrap"><p>{BODY}</p></section></div></body>',
        f'<body><div data-id="menu"><p>{BODY}</p></div></body>',
        f"""<body><div data-json="{'<b>x</b> ' * 600}"><p>{BODY}</p></div></body>""",
        f'<body><div class="page-sidebar"><p>Other words</p></div><div hidden><p>Other words</p></div><div style="display: none"><p>Other words</p></div><div class="ad-slot">Other words</div><p>{BODY}</p></body>',
    ],
)
def test_layout_classes_do_not_drop_the_content(page):
    assert maintext.main_text(page, maintext.Weights({}, {})) == BODY


class Flat:
    """One weight for all words and one for all tags."""

    def of(self, key):
        return 1.0 if key.startswith("word") else -0.01


def test_learned_weights_decide():
    """Where nothing marks the content, link lists and blocks with names from outside stay out by their scores alone."""
    from collections import Counter

    links = "<ul>" + "".join(f"<li><a href=/{i}>Link {i}</a></li>" for i in range(8)) + "</ul>"
    teaser = "<div class='teaser box-7'><p>Read this other story</p></div>"
    words = "<p>Plain words of the story itself stand here.</p>"
    inner, outer = Counter(), Counter()
    for _ in range(60):
        i, o = maintext.counts(f"<body>{links}{teaser}<article class='story'><h1>Head</h1>{words * 3}</article>{links}</body>")
        inner.update(i)
        outer.update(o)
    assert outer[".teaser"] == 60 and not inner[".teaser"] and inner[".story"] == 60
    learned = maintext.Weights(inner, outer)
    page = f"<body>{links}{teaser}<div class='story'>{words * 3}</div>{teaser}{links}</body>"
    want = "\n\n".join(["Plain words of the story itself stand here."] * 3)
    assert maintext.main_text(page, learned) == want
    assert "Link 3" in maintext.main_text(page, Flat()) and "other story" in maintext.main_text(page, Flat())
    # one name decides
    del outer[".teaser"], outer[".box-7"]
    outer["+div"] = outer["-div"] = 0
    assert "other story" in maintext.main_text(page, maintext.Weights(inner, outer))


def test_the_walk_is_bounded_by_score():
    """An article goes on to its end past a cut-out advert and a short last block, but not where that outweighs the rest."""
    flat = maintext.Weights({"word p": 50, "+p": 50}, {"+li": 400, "-li": 400, "+div": 90, "-div": 90})
    page = f"<article><p>{BODY}</p><div class=ad>{'Buy this now. ' * 500}</div><div>End.</div></article>"
    assert maintext.main_text(page, flat) == f"{BODY}\n\nEnd."
    farm = "<article><p>A few words.</p><ul>" + "<li><a href=/>x</a></li>" * 300 + "</ul></article>"
    assert maintext.main_text(farm, flat) == "A few words."
