"""Main text of pages, and templates of hosts."""

from rowrelay.llm import templates
from rowrelay.llm.queries import op7_site_templates


def test_markup():
    page = """<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{}</style><script>var t="</p>";x<1</script></head>
    <body><header>Site</header><nav><ul><li>Menu</li></ul></nav><!-- c <p>no</p> --><div class="ad">Buy</div>
    <article class="post"><header><h1>Big&nbsp;title</h1></header><p>One   <b>bo<i>ld</i></b> a &lt; b<br>next
    line<p>Two &eacute; &#x41;<div class="share-box">Share</div><ul><li>x<li>y</ul><table><tr><td>c1<td>c2</table>
    <p title="a > b">Quoted<footer>foot</footer><section id="comments"><p>First!</p></section><p>a < b & c</article>
    <aside>Side</aside><p>Outside</p><footer>&copy;</footer></body></html>"""
    assert templates.main_text(page).split("\n") == ["Big title", "One bold a < b next line", "Two é A", "x", "y", "c1", "c2", "Quoted", "a < b & c"]


def test_cut_off_and_odd_markup():
    assert templates.main_text("") == ""
    assert templates.main_text("plain &amp; simple") == "plain & simple"
    assert templates.main_text("<article><p>One</p><p>Two &am") == "One\nTwo &am"
    assert templates.main_text("<article><p>One</p><p>Two</artic") == "One\nTwo"
    assert templates.main_text("<p>One<script>never closed <p>x") == "One"
    assert templates.main_text('<p>One<a href="unclosed>Two</a>') in ("One", "OneTwo")
    assert templates.main_text("</div><p>One</b></p></p><!-- open") == "One"
    assert templates.main_text("<main><nav>n</nav>Text</main><div>Other</div>") == "Text"
    assert templates.main_text("<div hidden>h</div><div style='display: none'>n</div><div aria-hidden=true>a</div><div role=banner>b</div><p>ok") == "ok"
    assert len(templates.main_text("<p>" + "word " * 300_000 + "</p>")) == 5 * 300_000 - 1
    deep = "<div>" * 5000 + "deep" + "</div>" * 5000
    assert templates.main_text(deep) == "deep"


def test_inline_elements_that_are_dropped():
    page = "<article><p>One <span class='ad'>Buy</span> two</p><button>Share</button><p>Three<noscript>No script</noscript> <textarea>t</textarea><b hidden>h</b><em>four</em></p></article>"
    assert templates.main_text(page) == "One two\nThree four"


def frame(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, text string")


def test_templates_of_a_host(spark):
    """What recurs on different pages of a host goes; copies of a page and prose in articles stay."""
    box = "<div class='x1'><p>Join our list</p></div>"
    rows = [(i, f"https://a.example/{i}", f"<body>{box}<div><p>Text number {i}</p></div></body>", "") for i in range(6)]
    rows += [(100 + i, f"https://b.example/{i}", f"<body>{box}<div><p>Text number {i}</p></div></body>", "") for i in range(3)]
    rows += [(200 + i, f"https://c.example/{i}", "<body><div><p>One copied page</p></div></body>", "") for i in range(20)]
    rows += [(300 + i, f"https://d.example/{i}", f"<article><p>Same line</p><p>Own {i}</p><div>Read more</div></article>", "") for i in range(9)]
    rows += [(400, None, f"<body>{box}z</body>", ""), (401, "", None, ""), (None, "https://a.example/n", f"<body>{box}null id</body>", ""), (0, "https://a.example/0", rows[0][2], "")]
    found = [(r.page_id, r.text) for r in templates.extracted(frame(spark, rows)).collect()]
    texts = dict(found)
    assert [texts[i] for i in range(6)] == [f"Text number {i}" for i in range(6)]
    assert [texts[100 + i] for i in range(3)] == [f"Join our list\nText number {i}" for i in range(3)]
    assert {texts[200 + i] for i in range(20)} == {"One copied page"}
    assert [texts[300 + i] for i in range(9)] == [f"Same line\nOwn {i}" for i in range(9)]
    assert (texts[400], texts[401], texts[None]) == ("Join our list\nz", "", "null id")
    assert sorted(map(str, found)).count(str((0, "Text number 0"))) == 2
    assert templates.extracted(frame(spark, rows).limit(0)).count() == 0


def test_prose_that_pages_share_stays(spark):
    """Syndicated article bodies, whatever wraps them, and what only a small share of a host's pages has."""
    body = "<p>The same story</p><p>Told again</p>"
    loose = "a text of more than ten words without any paragraph around it"
    wraps = ["div class=body", "section", "details", "address"]
    rows = [(10 * k + i, f"https://w{k}.example/{i}", f"<article><h1>Title {i}</h1><{w}>{body}</{w.split()[0]}><div>{loose}</div><div>Read more</div></article>", "") for k, w in enumerate(wraps) for i in range(6)]
    rows += [(100 + i, f"https://big.example/{i}", f"<body><div>Menu of all</div><p>Text {i}</p>{'<h2>Summary</h2><p>Shared passage</p>' if i < 6 else ''}</body>", "") for i in range(60)]
    texts = {r.page_id: r.text for r in templates.extracted(frame(spark, rows)).collect()}
    assert [texts[10 * k + i] for k in range(4) for i in range(6)] == [f"Title {i}\nThe same story\nTold again\n{loose}" for _ in range(4) for i in range(6)]
    assert [texts[100 + i] for i in range(60)] == [f"Text {i}" + ("\nSummary\nShared passage" if i < 6 else "") for i in range(60)]


def test_query_gives_the_articles(spark):
    """The pages' articles are documents: heading and paragraphs, here by a plain search."""
    import html
    import re

    folder = "/root/testdata/sf0.01"
    pages = {r.page_id: r for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    found = op7_site_templates(spark, folder)
    assert found.columns == ["page_id", "url", "text", "n_chars"]
    rows = found.collect()
    assert len(rows) == len(pages)
    for r in rows:
        body = re.search(r"<article>(.*?)(</article>|$)", pages[r.page_id].html, re.S)
        blocks = re.split(r"</?(?:p|h1)>", re.sub(r"</?(?:b|br)>", "", re.sub(r"</?[a-z0-9]*$", "", body[1]))) if body else []
        wanted = [" ".join(html.unescape(b).split()) for b in blocks]
        assert r.text == "\n".join(b for b in wanted if b)
        assert (r.n_chars, r.url) == (len(r.text), pages[r.page_id].url)


def test_bad_markup_takes_linear_time():
    """A megabyte of each kind; walking all open elements at each tag took minutes."""
    import time

    size = 1_000_000
    pages = {p: p * (size // len(p)) for p in ("<i></b>", "<ul><li>x", "<p><b>", "<div>x", '<a href="', "<!--", "</p>", "<head><title>")}
    pages["<span> then <h1>"] = "<span>" * (size // 12) + "<h1>" * (size // 8)
    took = {}
    for name, page in pages.items():
        start = time.perf_counter()
        templates.main_text(page)
        took[name] = time.perf_counter() - start
    assert max(took.values()) < 8, took


def test_recurrence_alone_tells_menu_from_text(spark):
    """Pages without helpful names: a block goes if and only if a plain count finds it on enough pages."""
    import random
    from collections import Counter

    rng, rows, blocks = random.Random(4), [], {}
    for host in range(4):
        pool = [f"line {host} {i}" for i in range(30)]
        size = rng.choice([8, 20, 40])
        for page in range(size):
            own = [f"own text {host} {page}", *rng.sample(pool, rng.choice([2, 6, 12])), *pool[: rng.choice([0, 2])]]
            rng.shuffle(own)
            key = 100 * host + page
            blocks[key] = (host, list(dict.fromkeys(own)))
            body = "".join(f"<div class='x{len(t) % 3}'>{t}</div>" for t in blocks[key][1])
            rows.append((key, f"https://h{host}.example/{page}", f"<html><body>{body}</body></html>", ""))
    pages, times = Counter(h for h, _ in blocks.values()), Counter((h, t) for h, own in blocks.values() for t in own)
    texts = {r.page_id: r.text for r in templates.extracted(frame(spark, rows)).collect()}
    wanted = {k: "\n".join(t for t in own if times[h, t] < max(templates.PAGES, templates.SHARE * pages[h])) for k, (h, own) in blocks.items()}
    assert texts == wanted
    dropped = sum(times[h, t] >= max(templates.PAGES, templates.SHARE * pages[h]) for h, own in blocks.values() for t in own)
    assert 0 < dropped < sum(len(own) for _, own in blocks.values())
    plain = {r.page_id: r.text for r in templates.extracted(frame(spark, rows), min_pages=10**9).collect()}
    assert all(plain[k] == "\n".join(own) for k, (_, own) in blocks.items())
