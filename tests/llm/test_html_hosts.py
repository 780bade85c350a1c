from html.parser import HTMLParser

import numpy as np

from tests.conftest import SF001, SF01
from tillwise.llm import html_hosts, queries


class Article(HTMLParser):
    """The blocks inside <article>, by the standard library's parser."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.blocks, self.parts, self.depth = [], [], 0

    def flush(self):
        text = " ".join("".join(self.parts).split())
        self.blocks += [text] * bool(text)
        self.parts = []

    def handle_starttag(self, tag, attrs):
        if tag in html_hosts.BLOCK_TAGS:
            self.flush()
        self.depth += tag == "article"
        if tag == "br":
            self.parts.append(" ")

    def handle_endtag(self, tag):
        if tag in html_hosts.BLOCK_TAGS:
            self.flush()
        self.depth -= tag == "article"

    def handle_data(self, data):
        if self.depth > 0:
            self.parts.append(data)


def plain(html):
    parser = Article()
    parser.feed(html or "")
    parser.close()
    parser.flush()
    return "\n".join(parser.blocks)


def test_whole_tables(spark):
    for sf in (SF001, SF01):
        pages = spark.read.parquet(f"{sf}/pages.parquet").collect()
        want = sorted((r.page_id, r.url, plain(r.html), len(plain(r.html))) for r in pages)
        assert sum(bool(w[2]) for w in want) > 0.9 * len(want)
        assert sorted(map(tuple, queries.op8_host_html(spark, sf).collect())) == want


PAGE = """<html><head><title>T</title><style>p{}</style></head><body class="page with-sidebar"><header><h1>Site</h1></header>
<div class="cookie-notice">We use cookies</div><nav>Home News</nav><main><article class="post"><h2>Head &amp; line</h2>
<p>First  <b>bold</b>text&nbsp;here<br>next &lt;tag&gt;</p><script>var a = "</p><p>no";</script><aside>Also read</aside><p>Second &#233; &#x41;.
<div class="share-buttons"><span>Share</span></div><ul><li>one<li>two</ul><section id="comments"><article class="comment"><p>Nice!</p></article></section></article>
<form><label>Mail</label></form></main><!-- <p>hidden</p> --><footer>&copy; me</footer></body></html>"""


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_structure(spark, folder):
    rows = [(1, "http://a.example/1", PAGE), (2, "http://a.example/2", None), (3, None, ""), (3, None, ""), (None, "no url", "<p>text</p>"), (4, "http://b.example", "<article><p>cut off &amp"), (5, "http://b.example", "<article><p>cut <b"), (6, "http://c.example", "a < b <article>x < y</article>"),
            (7, "http://d.example", "<article>" + "<p>long</p>" * 20_000), (8, "http://d.example", "<div class=ad>buy<div>x</div></div><p class=notice>old<p>kept text"), (9, "http://e.example", "<body><nav>menu</nav></body>")]
    got = queries.op8_host_html(spark, folder(pages=pages(spark, rows))).collect()
    texts = {r.page_id: r.text for r in got}
    assert len(got) == len(rows) and all(r.n_chars == len(r.text) for r in got)
    assert texts[1] == "Head & line\nFirst boldtext here next <tag>\nSecond é A.\none\ntwo"
    assert (texts[2], texts[3], texts[4], texts[5], texts[6]) == ("", "", "cut off &", "cut", "x < y")
    assert texts[7] == "\n".join(["long"] * 20_000)
    assert (texts[8], texts[9], texts[None]) == ("kept text", "", "text")


def test_repeated_blocks_of_a_host_go(spark, folder):
    rows = []
    for host in range(3):
        for i in range(20):
            body = f"<div>Menu one two three four {host}</div><div>Own words of page {i} at host {host} {' '.join(str(i * 100 + k + host) for k in range(12))}</div><div>All rights reserved by somebody at {host}</div>"
            rows.append((host * 100 + i, f"https://user@H{host}.example:80/{i}", f"<body>{body}</body>"))
    got = {r.page_id: r.text for r in queries.op8_host_html(spark, folder(pages=pages(spark, rows))).collect()}
    for host in range(3):
        for i in range(20):
            assert got[host * 100 + i].startswith(f"Own words of page {i} at") and "\n" not in got[host * 100 + i]


def test_copied_articles_stay(spark, folder):
    rows = [(i, "http://a.example/x", "<article><p>the very same article on some pages of this host</p></article>" if i % 3 == 0 else f"<article><p>{' '.join(f'w{i}x{k}' for k in range(9))}</p></article>") for i in range(30)]
    got = {r.page_id: r.text for r in queries.op8_host_html(spark, folder(pages=pages(spark, rows))).collect()}
    assert got[0] == got[3] == "the very same article on some pages of this host"


def test_named_containers(spark, folder):
    rows = [(i, "http://a.example/x", f"<body><div class=site-menu>Home News Contact us</div><div id=content><p>a story that several pages of this host carry in full</p><div class='reader-comments'><p>so true {i}</p></div></div><div>Imprint and terms of the site</div></body>") for i in range(6)]
    rows += [(i, "http://a.example/y", f"<div id=content><p>{' '.join(f'w{i}x{k}' for k in range(9))}</p></div>") for i in range(6, 40)]
    got = {r.page_id: r.text for r in queries.op8_host_html(spark, folder(pages=pages(spark, rows))).collect()}
    assert {got[i] for i in range(6)} == {"a story that several pages of this host carry in full"}


def test_hosts_of_copies_stay(spark, folder):
    rows = [(i, "http://a.example/x", "<article><p>one article that a host carries only</p></article>") for i in range(12)]
    rows += [(100 + i, "http://b.example/x", "<body><div>one page without any article markup</div></body>") for i in range(5)]
    rows += [(200 + i, "http://c.example/x", f"<article><p>{'a hot copy with some words' if i < 400 else ' '.join(f'w{i}x{k}' for k in range(9))}</p></article>") for i in range(600)]
    got = {r.page_id: r.text for r in queries.op8_host_html(spark, folder(pages=pages(spark, rows))).collect()}
    assert {got[i] for i in range(12)} == {"one article that a host carries only"}
    assert {got[100 + i] for i in range(5)} == {"one page without any article markup"}
    assert {got[200 + i] for i in range(400)} == {"a hot copy with some words"}


def test_hosts_of_near_copies_stay(spark):
    """Ten near copies of an article of seven blocks, one paragraph different: with markup, without, and beside boilerplate."""
    words = lambda name, n=12: " ".join(f"{name}x{k}" for k in range(n))
    blocks = [[words(f"p{j}" if j != 3 else f"own{i}") for j in range(7)] for i in range(10)]
    rows = [(i, "http://a.example/x", "<article>" + "".join(f"<p>{b}</p>" for b in blocks[i]) + "</article>") for i in range(10)]
    rows += [(100 + i, "http://b.example/x", "<body>" + "".join(f"<div>{b}</div>" for b in blocks[i]) + "</body>") for i in range(10)]
    rows += [(200 + i, "http://c.example/x", f"<article><p>{words(f'a{i}', 30)}</p><p>{words('more')}</p><p>{words(f'b{i}', 20)}</p></article>") for i in range(20)]
    got = {r.page_id: r.text for r in html_hosts.extract(pages(spark, rows)).collect()}
    for i in range(10):
        assert got[i] == got[100 + i] == "\n".join(blocks[i])
    assert all(got[200 + i] == f"{words(f'a{i}', 30)}\n{words(f'b{i}', 20)}" for i in range(20))


def test_groups_do_not_change_the_result(spark):
    """A rare notice on a large host goes; a passage in most of its main texts goes; both as with one group."""
    own = lambda i: " ".join(f"w{i}x{k}" for k in range(12))
    rows = [(i, "http://a.example/x", f"<body><div>{own(i)}</div>{'<div>a rare notice of this large host</div>' * (i % 150 == 0)}</body>") for i in range(600)]
    rows += [(1000 + i, "http://b.example/x", f"<article><p>{own(i)}</p>{'<p>read more about this on our site</p>' * (i % 10 < 7)}</article>") for i in range(40)]
    rows += [(2000 + i, "http://c.example/x", f"<article><p>{own(i)}</p>{'<p>this one stands on half of them</p>' * (i % 2)}</article>") for i in range(40)]
    made = [{r.page_id: r.text for r in html_hosts.extract(pages(spark, rows), pages=p).collect()} for p in (7, 512, 1000)]
    assert made[0] == made[1] == made[2] and len(made[0]) == len(rows)
    assert all(made[0][i] == own(i) for i in range(600)) and all(made[0][1000 + i] == own(i) for i in range(40))
    assert made[0][2001] == f"{own(1)}\nthis one stands on half of them"


def test_long_matches_only(spark):
    """Phrases of four words that other pages use do not make a paragraph repeated."""
    phrases = [" ".join(f"p{j}y{k}" for k in range(4)) for j in range(40)]
    rows = [(i, "http://a.example/x", f"<body><p>{' '.join(phrases[(i * 7 + k * (i + 1)) % 40] for k in range(9))}</p></body>") for i in range(20)]
    assert all(r.text for r in html_hosts.extract(pages(spark, rows)).collect())


def test_repeats_are_counted():
    tokens = np.array([1, 2, 3, 4, 5, 9, 1, 2, 3, 4, 7, 2, 3, 4, 5, 1, 2])
    page = np.array([0] * 5 + [1] * 6 + [2] * 6)
    want = [0] * len(tokens)
    for a in range(len(tokens) - 3):
        if page[a] == page[a + 3]:
            n = len({page[b] for b in range(len(tokens) - 3) if page[b] == page[b + 3] and (tokens[b: b + 4] == tokens[a: a + 4]).all()})
            for k in range(4):
                want[a + k] = max(want[a + k], n)
    assert html_hosts.repeated_on(tokens, page).tolist() == want


def test_empty_table(spark, folder):
    assert queries.op8_host_html(spark, folder(pages=pages(spark, []))).collect() == []
