"""Main text of marked, unmarked and broken pages."""

import math
import random
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from stridelake.llm import html_extraction as he
from tests.conftest import DATA


def text_of(html):
    return "\n\n".join(b[1] for b in he.page_blocks(html))


def test_article_without_its_surroundings():
    html = (
        '<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body><nav><ul><li><a href="/x">x</a></li></ul></nav>'
        '<!-- ad --><div class="ad">buy</div><header>site</header><article><h1>T &amp; &eacute;</h1><p><b>One\n  two.<br>three<p>Four</p><div class="comments"><p>hi</p></div><form>f</form></article>'
        '<aside>side</aside><div class="cookie-notice">ok</div><footer>&copy; me</footer></body></html>'
    )
    assert text_of(html) == "T & é\n\nOne two. three\n\nFour"


def test_broken_and_empty_pages():
    assert text_of("") == "" and text_of("plain <b>text") == "plain text"
    assert text_of("<article><p>a</div></p><ul><li>b<li>c</ul>") == "a\n\nb\n\nc"
    assert text_of("<article>x<script>never closed <p>y") == "x"
    assert text_of("a < b <p>c</p>") == "a < b\n\nc"


def test_entropy_removes_what_a_site_repeats(spark):
    rows = [(i, f"https://h.example.com/{i}", f"<body><div class=x1>Same words on all pages</div><div class=x2>page {i} has its own text</div></body>", "u") for i in range(12)]
    rows += [(50, "https://new.example.org/", "<body><div class=x1>Same words on all pages</div><div class=x2>alone</div></body>", "u"), (51, None, None, "u"), (52, "bad url", "", "u"), (53, "https://h.example.com/1", "<article>Same</article>", "u")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = {r["page_id"]: r["text"] for r in he.extract(pages).collect()}
    assert got == {i: f"page {i} has its own text" for i in range(12)} | {50: "alone", 51: "", 52: "", 53: "Same"}
    assert he.extract(pages.where("false")).count() == 0


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(n))


def test_branch_inside_the_article_goes_by_its_entropy(spark):
    """A box without any telling word, inside the article, whose lines change a little from page to page."""
    rng = random.Random(3)
    rows = []
    for i in range(40):
        box = "".join(f"<p>{x}</p>" for x in ("Get the paper by mail", "Our office is open from nine", f"Issue {i % 2}"))
        rows.append((i, f"https://h.example.com/{i}", f'<body class="has-sidebar"><article class="post has-share-buttons"><h1>{prose(rng, 4)}</h1><p>{prose(rng, 30)}</p><div class=x9>{box}</div><p>{prose(rng, 20)}</p></article></body>'))
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in he.extract(pages).collect()}
    for i, _, html in rows:
        own = [b[1] for b in he.page_blocks(html)]
        assert got[i] == "\n\n".join([own[0], own[1], own[-1]])
    # The same box on one page of a host that has no others stays: nothing speaks against it.
    alone = {r["text"] for r in he.extract(pages.limit(1)).collect()}
    assert alone == {"\n\n".join(b[1] for b in he.page_blocks(rows[0][2]))}


def plain_tree(pages):
    """Importance of every branch of every host by loops over pages, as the module's docstring defines it."""

    def entropy(counts, m):
        return 1.0 if m <= 1 else sum(n * math.log(m / n) for n in counts.values()) / (sum(counts.values()) * math.log(m))

    def shrunk(own, m, prior):
        return ((m - 1) * own + he.TRUST * prior) / (m - 1 + he.TRUST)

    def placed(b, importance):
        return he.PROSE + (1 - he.PROSE) * importance if b & 2 else importance

    known = {}
    distinct = {(url.split("/")[2], html) for _, url, html in pages}
    for host in {h for h, _ in distinct} | {None}:
        styles, contents, below = defaultdict(Counter), defaultdict(Counter), defaultdict(Counter)
        for _, html in [d for d in distinct if host in (None, d[0])]:
            page = he.Page(html)
            node = page.nodes()
            for n, c in dict(zip(node, page.children)).items():
                styles[n][tuple(c)] += 1
            for n, text in {(node[e], text) for e, text in page.blocks}:
                contents[n][text] += 1
            for e, _ in page.blocks:
                line, at = set(), e
                while at >= 0:
                    line.add(node[at])
                    at = page.parent[at]
                for b in line:
                    below[b][node[e]] += 1
        m = {n: sum(c.values()) for n, c in styles.items()}
        said = {n: entropy(c, m[n]) for n, c in contents.items()}
        for b, w in below.items():
            mean = sum(k * said[n] for n, k in w.items()) / sum(w.values())
            known[host, b] = (he.GAMMA * mean + (1 - he.GAMMA) * entropy(styles[b], m[b]), m[b])
    return {(h, b): (he.UNIMPORTANT if b & 1 else 1.0) * placed(b, shrunk(*x, shrunk(*known[None, b], 1.0))) for (h, b), x in known.items() if h}


def test_tree_equals_loops(spark):
    rng = random.Random(8)
    rows = []
    for i in range(60):
        extra = "".join(f"<div class=c{rng.randint(1, 3)}><p>{rng.choice(['a', 'b', 'c'])}</p>tail</div>" for _ in range(rng.randint(0, 3)))
        rows.append((i, f"https://h{rng.choice([1, 1, 1, 2, 3])}.org/x", f"<body><nav>{rng.choice('xy')}</nav><article><p>{rng.randint(0, 20)}</p>{extra}</article></body>"))
    features = he.page_features(spark.createDataFrame(rows + rows[:5], "page_id long, url string, html string"))
    got = {(r["host"], r["path"]): r["importance"] for r in he.style_tree(features)[0].collect()}
    expected = plain_tree(rows)
    assert got.keys() == expected.keys()
    assert all(abs(got[k] - expected[k]) < 1e-9 for k in got)


def test_repeated_null_and_long_rows(spark):
    long = "<article>" + "".join(f"<p>{i} words here</p>" for i in range(20000)) + "</article>"
    deep = "<div>" * 3000 + "deep" + "<p>x"
    rows = [(1, "https://a.org/", "<p>one</p>", 5), (1, "https://a.org/", "<p>one</p>", 5), (1, "https://b.org/", "<p>two</p>", 5), (None, None, "<p>three</p>", 5), (2, "https://a.org/2", long, 5), (3, "u", deep, 5)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, host int")
    got = sorted(((r["page_id"] or 0, r["text"]) for r in he.extract(pages).collect()))
    texts = ["\n\n".join(f"{i} words here" for i in range(20000)), "deep\n\nx"]
    assert got == [(0, "three"), (1, "one"), (1, "one"), (1, "two"), (2, texts[0]), (3, texts[1])]


def test_prose_of_articles_stays_though_it_repeats(spark):
    rows = [(i, f"https://h.example.com/{i}", f"<article><h1>Same title</h1><p>Same words</p><p>own {i}</p><p class=note2>Same note</p></article>") for i in range(30)]
    got = {r["page_id"]: r["text"] for r in he.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {i: f"Same title\n\nSame words\n\nown {i}" for i in range(30)}


def test_main_element_decides_over_words():
    html = "<form><div class=sidebar><main id=content><p>long enough text</p><aside>gone</aside></main></div></form><article class=comments><p>hi</p></article>"
    assert text_of(html) == "long enough text"
    assert text_of("<div role=main class=menu><p>a</p></div><p>b</p>") == "a\n\nb"


def test_entropy_wins_over_the_place_on_a_large_host(spark):
    """In the article a line of nearly all pages goes, one of a third of them stays, and so does what differs."""
    rows = [(i, f"https://h.example.com/{i}", f"<article><h1>title {i}</h1><p>Always the same</p><p>{'now and then' if i % 3 == 0 else f'own {i}'}</p></article>") for i in range(400)]
    got = {r["page_id"]: r["text"] for r in he.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {i: f"title {i}\n\n" + ("now and then" if i % 3 == 0 else f"own {i}") for i in range(400)}


def test_most_blocks_of_the_test_pages_are_left_to_the_tree(spark):
    """No fixed rule decides them: they are unmarked, and their importance comes from entropies, prose or not."""
    pages = spark.read.parquet(f"{DATA}/pages.parquet").select("page_id", "url", "html")
    ruled = told = 0
    for row in pages.collect():
        page = he.Page(row["html"] or "")
        marked = sum(e >= 0 and page.marked[e] for e, _ in page.blocks)
        ruled, told = ruled + marked, told + len(page.blocks) - marked
    assert told > ruled
    branches, _ = he.style_tree(he.page_features(pages))
    found = branches.where(F.col("path").bitwiseAND(F.lit(1)) == 0).agg(F.count_distinct("importance").alias("n"), F.max("importance").alias("top"), F.min("importance").alias("low")).first()
    assert found["n"] >= 10 and found["low"] < found["top"] <= 1
