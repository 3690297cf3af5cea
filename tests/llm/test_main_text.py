import html
import random
import re
import time
from collections import defaultdict

import numpy as np

from quarry.llm.main_text import Stream, blocks, extract_main_text, fingerprints, main_text, repeated, winnowed
from quarry.llm.textops import runs
from tests.conftest import SF_SMALL


def brute_repeated(pages, run):
    seen = {}
    for k, p in enumerate(pages):
        for a in range(len(p) - run + 1):
            seen.setdefault(tuple(p[a:a + run]), set()).add(k)
    out = []
    for p in pages:
        hit = [False] * len(p)
        for a in range(len(p) - run + 1):
            if len(seen[tuple(p[a:a + run])]) > 1:
                hit[a:a + run] = [True] * run
        out += hit
    return out


def test_suffix_array_finds_every_shared_run():
    rng = np.random.default_rng(2)
    for run in (1, 2, 3, 5, 8):
        pages = [rng.integers(0, 3, rng.integers(0, 60)).tolist() for _ in range(6)]
        tokens = np.array([t for p in pages for t in p], np.uint64)
        page_of = np.repeat(np.arange(len(pages)), [len(p) for p in pages])
        assert repeated(tokens, page_of, run).tolist() == brute_repeated(pages, run)


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="<p>no</p>";</script></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href="/a">Menu<li>More</ul></nav><!-- <p>hidden</p> --><div class="ad">Buy</div>
<article><h1>Title &amp; more</h1><p>First <b>bold</b>
  line<br>next<p>Second&nbsp;one &copy; &am</p><div class="notice">Notice</div><form><p>Field</p></form>
<aside><p>Side</p></aside><section id="comments"><article class="comment"><p>Reader</p></article></section><p>Last</article>
<footer>&copy; Site</footer></body></html>"""


def test_structure_decides_where_a_host_has_one_page():
    own = blocks(PAGE)
    assert main_text(own, [False] * len(own), None) == ("Title & more\nFirst bold line next\nSecond one © &am\nLast", False)


def extracted(spark, pages, **options):
    """[(text, by_runs)] of pages of one host, in order."""
    rows = [(k, f"http://h.example/{k}", t) for k, t in enumerate(pages)]
    got = extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3), **options).collect()
    return [(r["text"], r["by_runs"]) for r in sorted(got, key=lambda r: r["page_id"])]


def story(rng, n):
    return " ".join("".join(rng.choices("abcdefghij", k=6)) for _ in range(n))


def test_runs_find_the_main_element_without_tags_that_name_it(spark):
    rng = random.Random(1)
    menu, notice = story(rng, 30), story(rng, 25)
    copied = story(rng, 60)
    want, pages = [], []
    for k in range(40):
        own = [story(rng, 12), story(rng, 90), *([copied] if k % 4 == 0 else [])]
        want.append("\n".join(own))
        inner = f"<div class=title{k}>{own[0]}</div>" + "".join(f"<p>{x}</p>" for x in own[1:])
        pages.append(f"<html><body><div class=top>{menu}</div><div class=post>{inner}<div class=hint>{notice}</div><form><p>{story(rng, 9)}</form></div>"
                     f"<div class=side><p>{story(rng, 3)} {menu}</p></div></body></html>")
    got = extracted(spark, pages)
    assert got == [(w, True) for w in want]
    # Chunks, partitions and parts of a host do not change the result.
    assert extracted(spark, pages, chunk_pages=3, host_pages=7) == got


def test_without_a_main_element_covered_blocks_go(spark):
    rng = random.Random(2)
    menu = story(rng, 40)
    own = [story(rng, 30) for _ in range(12)]
    pages = [f"<body><div>{menu}</div><div>{w}</div></body>" for w in own]
    assert extracted(spark, pages) == [(w, False) for w in own]
    assert extracted(spark, pages[:1] * 3)[0][0].startswith(menu)  # copies of one page are one page


def test_paths_are_judged_as_a_plain_count_of_shared_runs_says(spark):
    """Fingerprints of a host against sets of tuples: every shared passage of min_run + window - 1 tokens leaves one."""
    rng = random.Random(3)
    passages = [story(rng, 15) for _ in range(4)]
    pages = [" ".join(rng.choice(passages) if rng.random() < 0.3 else story(rng, 1) for _ in range(40)) for _ in range(20)]
    stream = Stream(pages)
    page = np.arange(20, dtype=np.uint64)
    _, keys, n, low, high = fingerprints(stream, page, 8, 8)
    seen = defaultdict(set)
    where = defaultdict(set)
    values = runs(stream.tokens, 8)
    for at in stream.inner(8).tolist():
        seen[int(values[at])].add(int(stream.row[at]))
        where[int(stream.row[at])].add(int(values[at]))
    assert {int(k): (int(a), int(b)) for k, a, b in zip(keys, low, high, strict=True)} == {
        int(k): (min(seen[int(k)]), max(seen[int(k)])) for k in keys}
    shared = {int(k) for k, a, b in zip(keys, low, high, strict=True) if a < b}
    for passage in passages:
        having = [k for k, p in enumerate(pages) if passage in p]
        if len(having) > 1:
            assert all(shared & where[k] for k in having)
    assert n.min() > 0


def test_winnowing_keeps_the_least_of_every_window():
    rng = np.random.default_rng(4)
    for _ in range(50):
        group = np.sort(rng.integers(0, 4, 60))
        values = rng.integers(0, 20, 60)
        window = int(rng.integers(1, 9))
        want = np.zeros(60, bool)
        for g in range(4):
            own = np.flatnonzero(group == g)
            size = min(window, len(own))
            for a in range(len(own) - size + 1) if len(own) else ():
                part = own[a:a + size]
                want[part[values[part].argmin()]] = True
        assert (winnowed(values, group, window) == want).all()


def test_broken_markup_takes_linear_time():
    begun = time.time()
    for unit in ("<div>x", "<a ", '<a "', "</p>", "<p", "<b><i>", "<b><p>", "<a '>\"", "<!", "<!-", "<li class='", "<script", "&", "<p>x</span>"):
        assert blocks(unit * (1_000_000 // len(unit))) is not None
    assert time.time() - begun < 60


def test_whole_table(spark):
    """Every page of the table against a plain cut of its article."""
    rows = {r["page_id"]: r for r in extract_main_text(spark.read.parquet(f"{SF_SMALL}/pages.parquet")).collect()}
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect()
    assert len(rows) == len(pages)
    for p in pages:
        body = re.search(r"<article>(.*?)</article>", p["html"], re.S)[1]
        parts = [" ".join(html.unescape(re.sub("<[^>]*>", " ", x)).split()) for x in re.split("<h1>|</h1>|</?p>", body)]
        assert rows[p["page_id"]]["text"] == "\n".join(x for x in parts if x)
        assert rows[p["page_id"]]["n_chars"] == len(rows[p["page_id"]]["text"])


def test_awkward_pages(spark):
    texts = [None, "", "<", "<p", "text only", "<article>", "<script>never ends", "<!-- never ends", "&#x41;&lt;b&gt;", "<p>" * 5_000 + "deep",
             "<div>" * 3_000 + "x", "<article><p>long " + "word " * 50_000 + "</article>", "<article>same</article>", "<article>same</article>"]
    rows = [(k, None if k % 3 == 0 else f"http://h{k % 2}.example/{k}", t, "x", "y") for k, t in enumerate(texts)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, host string, spread string")
    got = {r["page_id"]: r for r in extract_main_text(pages).collect()}
    assert [got[k]["text"] for k in (0, 1, 4, 5, 6, 8, 12, 13)] == ["", "", "text only", "", "", "A<b>", "same", "same"]
    assert got[11]["n_chars"] == len("long " + "word " * 50_000) - 1
    assert extract_main_text(pages.limit(0)).count() == 0


def test_blocks_close_open_paragraphs():
    assert [b[2] for b in blocks("<p class=ad>a<p>b<div>c")] == ["a", "b", "c"]
    assert [b[0] for b in blocks("<p class=ad>a<p>b<div>c")] == [2, 0, 0]
    assert [b[1] for b in blocks("<div class='x1 y'><p id=a2>a<b>b</b></div>c")] == ["div.x/p.a", ""]
    assert [b[2] for b in blocks("<p title=\"a>b\">one<p title='it>two<img alt=>three")] == ["one", "twothree"]


def test_class_names_do_not_empty_an_article():
    a, b = "Its own story of the day", "Told in a second paragraph"
    for page in (f'<div class="has-sidebar"><article><p>{a}<p>{b}</article><div class="sidebar">Side</div></div>',
                 f'<div id="search-results"><p>{a}<p>{b}</div>',
                 f'<article class="has-comments"><p>{a}<p>{b}<div class="comments">Reader</div></article>',
                 f'<article><div class="social-science"><p>{a}<p>{b}</div></article><div class="sidebar">Side</div>'):
        own = blocks(page)
        assert main_text(own, [False] * len(own), None)[0] == f"{a}\n{b}"


def test_articles_that_are_mostly_copies_stay_whole(spark):
    rng = random.Random(5)
    body = story(rng, 200)
    pages = [f"<html><body><nav>{story(rng, 4)}</nav><article><h1>The same title for all of these many pages here</h1><p>{body}</p>"
             f"<p>{story(rng, 30)}</p></article><footer>all rights reserved by the owner of this very host</footer></body></html>" for _ in range(30)]
    got = extracted(spark, pages)
    assert all(r and t.startswith("The same title") and body in t and "rights" not in t and len(t.split("\n")) == 3 for t, r in got)
