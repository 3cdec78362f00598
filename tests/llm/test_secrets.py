"""Secret spans and ownership against plain Python."""

import hashlib
import re

from rowrelay.llm import secrets
from rowrelay.llm.queries import op8_secret_scan


def slow_base(text):
    text = text or ""
    kinds = {
        "assign": [m for m in re.finditer(r"([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", text) if len(m[2]) >= 8],
        "access": [m for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16],
        "hex": [m for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32],
    }
    order = {"assign": 0, "access": 1, "hex": 2}
    spans = sorted(((m.start(), order[k], k, m.end()) for k, ms in kinds.items() for m in ms))
    joined = ",".join(f"{k}:{s}:{e}" for s, _, k, e in spans)
    return tuple(len(kinds[k]) for k in order), hashlib.sha256(joined.encode()).hexdigest(), joined


def test_query_against_plain_search(spark):
    folder = "/root/testdata/sf0.01"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    found = op8_secret_scan(spark, folder).collect()
    assert len(found) == len(docs)
    for r in found:
        counts, digest, joined = slow_base(docs[r.doc_id])
        assert ((r.n_assign, r.n_access, r.n_hex), r.base_sha256) == (counts, digest)
        assert set(joined.split(",")) <= set(r.spans.split(","))
    assert any(r.n_assign for r in found)


VALUE = "Zx81kQp92LmV40sTf7Ra"
HEX = "0123456789abcdef" * 2


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long, spans string")


def test_ownership_decides_further_values(spark):
    shared = "Qw82jEr93TyU41iOp6As"
    rows = [(i, f"see {shared} here", f"s{i}", 1, "") for i in range(5)]
    rows += [(10, f"é use {VALUE} now", "a", 1, ""), (11, f"{VALUE}", "a", 1, ""), (12, f"{VALUE}", None, 1, "")]
    rows += [(20, f"token: {HEX}", "a", 1, ""), (21, None, "a", 1, ""), (22, "", None, 1, ""), (None, "API_KEY='abcdefgh'", "a", 1, ""), (23, "ſecret=abcdefghij toKen=short secret=token:abcdefghi", "a", 1, "")]
    found = {r.doc_id: r for r in secrets.scan(frame(spark, rows)).collect()}
    assert {found[i].spans for i in range(5)} == {""}
    assert [found[i].spans for i in (10, 11, 12)] == ["value:6:26", "value:0:20", "value:0:20"]
    assert (found[20].spans, found[20].n_live) == (f"assign:0:39,hex:7:39", 2)
    assert (found[21].spans, found[22].spans, found[None].spans, found[23].spans) == ("", "", "assign:0:17", "")
    counts = {tuple(r)[1:] for r in secrets.ownership(secrets._scan(frame(spark, rows).selectExpr("doc_id", "0L digest", "source owner", "cast(doc_id as string) repository", "text"))).collect()}
    assert (5, 5, 5) in counts and (3, 3, 2) in counts
    wide = {r.doc_id: (r.n_live, r.n_copied) for r in secrets.scan(frame(spark, [(i, f"token={HEX}", f"s{i}", 1, "") for i in range(4)])).collect()}
    assert wide == {i: (0, 2) for i in range(4)}
    assert secrets.scan(frame(spark, rows).limit(0)).count() == 0


def test_copies_inside_one_source(spark):
    """A value in many documents of one source, or of two, is an example; many copies in one repository are not."""
    rows = [(i, f"see {VALUE} here", "hot", 1, "") for i in range(30)]
    rows += [(100 + i, f"see {VALUE[::-1]} here", "hot", 1, "") for i in range(10)] + [(200, f"see {VALUE[::-1]} here", "b", 1, "")]
    rows += [(300, f"see {VALUE.swapcase()} here", "hot", 1, "") for _ in range(30)]
    found = secrets.scan(frame(spark, rows)).collect()
    assert {(r.doc_id // 100, r.spans, r.n_live) for r in found} == {(0, "", 0), (1, "value:4:24", 1), (2, "value:4:24", 1), (3, "value:4:24", 1)}
    token = secrets.scan(frame(spark, [(i, f"token={HEX}", "hot", 1, "") for i in range(30)])).collect()
    assert {(r.n_assign, r.n_hex, r.n_live, r.n_copied) for r in token} == {(1, 1, 0, 2)}
    done = secrets.redacted(frame(spark, rows)).collect()
    assert {(r.doc_id // 100, secrets.MASK in r.text) for r in done} == {(0, False), (1, True), (2, True), (3, True)}


def test_long_and_repeated_rows(spark):
    text = "ab " * 100_000 + f"token={HEX} " + "x" * 50_000
    found = secrets.scan(frame(spark, [(1, text, "a", 1, "")] * 3)).collect()
    assert [r.spans for r in found] == [f"assign:300000:300038,hex:300006:300038"] * 3
    own = secrets.scan(frame(spark, [(1, f"{VALUE}", "a", 1, "r1"), (2, f"{VALUE}", "a", 1, None)]), repository_col="spans").collect()
    assert [r.spans for r in own] == ["value:0:20"] * 2


def test_redacted(spark):
    rows = [(1, f"é token={HEX} end", "a", 5, "k"), (2, "nothing here", "a", 12, "k"), (None, f"{VALUE} x", "b", 22, None), (3, None, "a", None, "k")]
    docs = frame(spark, rows)
    done = secrets.redacted(docs)
    assert done.schema == docs.schema
    assert sorted(map(tuple, done.collect()), key=str) == sorted([(1, "é <secret> end", "a", 14, "k"), (2, "nothing here", "a", 12, "k"), (None, "<secret> x", "b", 10, None), (3, None, "a", None, "k")], key=str)
    assert secrets.masked("abcdef", [(1, 3), (2, 4), (5, 6)], "_") == "a_e_"
