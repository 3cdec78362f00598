"""WARC derivatives: links, digests, and files that read back."""

import gzip
import hashlib

from rowrelay.llm import warc


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, block string")


PAGE = '<html><head><title>A &amp;\n b</title><script>x<y</script></head><body><p>One&nbsp;two <b>th</b>ree</p><!-- no --><div>é &lt;tag&gt;</div><a class=x href="/q?a=1&amp;b=2">l</a></body></html>'


def test_records_are_linked(spark):
    found = warc.responses(pages(spark, [(1, "http://a/1", PAGE, "x")]))
    source = found.first()
    rows = {r.warc_type: r for r in warc.derivatives(found).collect()}
    assert set(rows) == {"metadata", "conversion"}
    assert rows["conversion"].block == "One two three\né <tag>\nl"
    assert rows["metadata"].block.split("\r\n")[0] == "title: A & b"
    assert "outlink: /q?a=1&b=2" in rows["metadata"].block.split("\r\n")
    assert "source-header: Content-Type: text/html; charset=utf-8" in rows["metadata"].block.split("\r\n")
    for r in rows.values():
        raw = r.block.encode()
        assert (r.refers_to, r.source_digest) == (source.record_id, source.payload_digest)
        assert (r.content_length, r.block_digest) == (len(raw), "sha256:" + hashlib.sha256(raw).hexdigest())
        lines = dict(x.split(": ", 1) for x in r.header.split("\r\n")[1:])
        assert (lines["WARC-Refers-To"], lines["Content-Length"], lines["WARC-Target-URI"]) == (r.refers_to, str(len(raw)), "http://a/1")
    assert len({r.record_id for r in rows.values()} | {source.record_id}) == 3


def test_edge_rows(spark):
    rows = [(1, None, None, ""), (None, "http://b/", "", ""), (2, "u", "x", ""), (2, "u", "x", ""), (3, "v", "<p>" + "w " * 200_000, ""), (4, "w", "<script>never closed", "")]
    found = warc.derivatives(warc.responses(pages(spark, rows))).collect()
    assert len(found) == 2 * len(rows)
    assert "WARC-Target-URI" not in [r for r in found if r.page_id == 1][0].header
    assert {r.block for r in found if r.page_id == 2 and r.warc_type == "conversion"} == {"x"}
    again = warc.derivatives(warc.responses(pages(spark, rows).repartition(3))).collect()
    assert sorted(r.record_id for r in again) == sorted(r.record_id for r in found)
    assert warc.derivatives(warc.responses(pages(spark, rows).limit(0))).count() == 0


def test_files_read_back(spark, tmp_path):
    rows = [(i, f"http://a/{i}", f"<title>t{i}</title><p>line {i}</p><p>é</p>", "") for i in range(5)]
    records = warc.derivatives(warc.responses(pages(spark, rows)))
    warc.write_warc(records, str(tmp_path / "out"))
    data = b"".join(gzip.open(f).read() for f in sorted((tmp_path / "out").glob("*.gz")))
    found = []
    while data:
        header, data = data.split(b"\r\n\r\n", 1)
        fields = dict(x.split(": ", 1) for x in header.decode().split("\r\n")[1:])
        size = int(fields["Content-Length"])
        found.append((fields["WARC-Record-ID"], data[:size].decode()))
        assert data[size : size + 4] == b"\r\n\r\n"
        data = data[size + 4 :]
    assert sorted(found) == sorted((r.record_id, r.block) for r in records.collect())
