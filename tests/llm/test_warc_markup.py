"""Character references, links and blocks of pages, against Python's decoder and the query's SQL."""

import html
import random
import time
from html.entities import html5

import duckdb
import pytest
from pyspark.sql import functions as F

from rowrelay.llm import oracle, queries, warc

PIECES = ["&", "#", "x", "X", ";", "amp", "lt", "notin", "not", "copy", "39", "8217", "27", "128", "150", "0", "55296", "1114112", "9" * 20, "1f600", "a", " ", "é", "=", "nbsp", "acE", "\n", "13", "fdd0", "ffff"]


def one(spark, function, text):
    return spark.createDataFrame([(text,)], "html string").select(function(F.col("html"))).first()[0]


def test_references_against_python(spark):
    rng = random.Random(3)
    texts = ["".join(rng.choice(PIECES) for _ in range(rng.randrange(14))) for _ in range(1500)] + [f"&{name}." for name in html5]
    found = spark.createDataFrame([(t,) for t in texts], "t string").select("t", warc.decoded(F.col("t")).alias("d")).collect()
    assert [r.d for r in found] == [html.unescape(r.t) for r in found]
    assert spark.createDataFrame([(None,)], "t string").select(warc.decoded(F.col("t"))).first()[0] is None


LINKS = {
    '<a href="/q?a=1&amp;b=2">': ["/q?a=1&b=2"],
    "<A class=x HREF = 'b c' >": ["b c"],
    "<a href=/q?a=1&copy=2&lt;>": ["/q?a=1&copy=2<"],
    '<a title="a>b" href="c">': ["c"],
    """<a title=' href="no"' href="yes">""": ["yes"],
    '<a x="y"href="z">': ["z"],
    '<a href="" href="second">': [""],
    '<a hidden href=u/><a\nhref\n=\n"w">': ["u/", "w"],
    '<a data-href="no"><abbr href="no"><a name="n"><a>': [],
    '<a href="never closed': [],
}


@pytest.mark.parametrize("text", LINKS)
def test_links(spark, text):
    assert one(spark, warc.outlinks, text) == LINKS[text]


TEXTS = {
    "<table><tr><td>a</td><td>b</td></tr><th>c</table>": "a\nb\nc",
    '<p title="a<b>c">x<b>y</b>z<figure>f</figure><dd>g': "xyz\nf\ng",
    "<header>h</header><link rel=x>i<hr/>j": "h\ni\nj",
    "<head><title>t</title><meta x></head><body class=c>a&nbsp; b": "a b",
    "1 < 2 &amp;lt; 3 <b don't>x</b>": "1 < 2 &lt; 3 x",
    "a<script>b": "a",
    "a<!-- b": "a",
    "<scripture>a</scripture>": "a",
}


@pytest.mark.parametrize("text", TEXTS)
def test_texts(spark, text):
    assert one(spark, warc.plain_text, text) == TEXTS[text]


def test_sql_on_the_same_markup(spark, tmp_path):
    rng = random.Random(5)
    bits = [*LINKS, *TEXTS, *PIECES, "<p>", "</td>", "<title>", "</title>", "<!--", "-->", '"', "'", "<", ">", "<a ", " href=", "text"]
    rows = [(i, f"u{i % 7}" if i % 5 else None, "".join(rng.choice(bits) for _ in range(rng.randrange(20))) if i % 11 else None) for i in range(400)]
    rows += [(None, "u", ""), (1, "u1", "x"), (1, "u1", "x")]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    found = queries.op2_warc_derivatives(spark, str(tmp_path))
    with duckdb.connect() as duck:
        duck.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{tmp_path}/pages.parquet/*.parquet')")
        wanted = duck.execute(oracle.WARC)
        names = [c[0] for c in wanted.description]
        rows = [dict(zip(names, r)) for r in wanted.fetchall()]
    order = lambda r: [str(r[c]) for c in sorted(names)]
    assert sorted(map(order, (r.asDict() for r in found.collect()))) == sorted(map(order, rows))


@pytest.mark.parametrize("piece", ["<a ", "<!--", "<title>", "<script>", '<a "', "<a href='x", "&", "<a x='y' ", "="])
def test_bad_markup_takes_linear_time(spark, piece):
    text = piece * (1_000_000 // len(piece))
    begun = time.monotonic()
    assert len(warc.derivatives(warc.responses(spark.createDataFrame([(1, "u", text)], "page_id long, url string, html string"))).collect()) == 2
    assert time.monotonic() - begun < 20
