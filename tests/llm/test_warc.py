import pytest
from pyspark.sql import functions as F
from starmill.llm import warc

PAGES = "page_id long, url string, html string"


def pages(spark, rows):
    return spark.createDataFrame(rows, PAGES).selectExpr("*", "'x' AS sha1", "'y' AS refers_to")


ROWS = [
    (1, "http://a", "<p>é日😀</p>" * 5000), (2, "http://b\r\nX: y", "same"), (3, None, "same"), (4, "u", None), (5, "u", ""),
    (6, "u", "WARC/1.1\r\nWARC-Type: response\r\n\r\n\r\n\r\n0\r\n\r\n"), (None, "u", "same"), (2, "u", "same"),
    (7, "u", "other"), (7, "u", "same"), (8, "u", "\x00"),
]


def brute(rows):
    firsts = {}
    for i, _, html in rows:
        if i is not None:
            firsts[html or ""] = min(i, firsts.get(html or "", i))
    out = []
    for i, _, html in rows:
        data, first = (html or "").encode(), firsts.get(html or "")
        again = i is not None and first < i
        out.append((i, len(data), warc.payload_digest(data), "revisit" if again else "response", first if again else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("segment, archive", [(warc.SEGMENT_BYTES, warc.ARCHIVE_BYTES), (200, 1000)])
def test_what_is_written_is_read_back(spark, tmp_path, segment, archive):
    path = str(tmp_path / "warc")
    warc.write_archives(pages(spark, ROWS), path, segment, archive)
    found = warc.read_archives(spark, path).collect()
    assert sorted((tuple(r)[:5] for r in found), key=str) == brute(ROWS)
    texts = {(r.page_id, r.html) for r in found if r.record_type == "response"}
    assert (1, ROWS[0][2]) in texts and (6, ROWS[5][2]) in texts and (4, "") in texts


def test_no_pages(spark):
    assert warc.archive_roundtrip(pages(spark, [])).collect() == []


def test_small_payloads_are_all_responses(spark, tmp_path):
    warc.write_archives(pages(spark, ROWS), str(tmp_path / "w"), least_bytes=5)
    found = warc.read_archives(spark, str(tmp_path / "w"))
    assert found.filter("record_type = 'revisit'").count() == 0


def test_missing_and_wrong_segments_fail(spark, tmp_path):
    path = str(tmp_path / "warc")
    warc.write_archives(pages(spark, [(1, "u", "x" * 5000)]), path, segment_bytes=1000)
    segments = warc.read_segments(spark, path)
    assert segments.count() > 4
    for bad in (segments.filter("number <> 3"), segments.withColumn("total_length", F.col("total_length") + 1),
                segments.filter("total_length is null")):
        with pytest.raises(Exception, match="segments missing"):
            warc.reassemble(bad).collect()


def test_chunks_and_cuts_end_between_code_points():
    data = "aé日😀".encode() * 100
    for size in (1, 4, 7, 100):
        assert b"".join(warc.cut(data, size)) == data
        assert all(p.decode() and len(p) <= max(size, 4) for p in warc.cut(data, size))
        assert warc.dechunked(warc.chunked(data, size)) == data
    assert warc.dechunked(b"3;x=y\r\nabc\r\n0\r\nT: v\r\n\r\n") == b"abc"
    for broken in (b"5\r\nabc\r\n0\r\n\r\n", b"3\r\nabc\r\n"):
        with pytest.raises(ValueError):
            warc.dechunked(broken)


def test_broken_records_fail():
    record = warc._record([("WARC-Type", "response")], b"abc") + b"\r\n\r\n"
    assert [b for _, b in warc.parse(record * 2)] == [b"abc", b"abc"]
    for bad in (record[1:], record.replace(b"Length: 3", b"Length: 2")):
        with pytest.raises(ValueError):
            list(warc.parse(bad))


def test_broken_records_are_kept_apart(spark, tmp_path):
    path = str(tmp_path / "warc")
    warc.write_archives(pages(spark, [(1, "u", "x" * 5000), (2, "u", "y"), (3, "u", "z" * 3000)]), path, segment_bytes=1000)
    segments = warc.read_segments(spark, path, keep_broken=True)
    lost = segments.filter("number IS NULL OR number <> 3 OR page_id = 3 OR total_length > 4000")
    found = {r.page_id: r for r in warc.reassemble(lost, keep_broken=True).collect()}
    assert "segments missing" in found[1].problem and found[1].block is None
    assert found[2].problem is None and found[2].block is not None
    # An archive that breaks off: its records up to there, and a row that tells of it.
    record = [b"".join(p + b"\r\n\r\n" for p in warc.page_records(
        "00000000-0000-0000-0000-00000000000%d" % k, k, "u", b"text", digest, None, 1000))
        for k, digest in ((7, warc.payload_digest(b"text")), (8, "wrong"), (9, ""))]
    (tmp_path / "cut").mkdir()
    (tmp_path / "cut" / "part-0").write_bytes(record[0] + record[1] + record[2][:-20])
    with pytest.raises(Exception, match="not as long|substring|subsection|digest"):
        warc.read_archives(spark, str(tmp_path / "cut")).collect()
    rows = warc.read_archives(spark, str(tmp_path / "cut"), keep_broken=True).collect()
    assert [(r.page_id, r.html) for r in rows if r.problem is None] == [(7, "text")]
    problems = sorted((r.page_id or 0, r.problem) for r in rows if r.problem)
    assert len(problems) == 2 and "part-0" in problems[0][1] and "digest" in problems[1][1]


def test_a_very_long_page_is_put_together(spark, tmp_path):
    text = "é<p>long page</p>\n" * 700_000  # 13 MB in 13 segments
    warc.write_archives(pages(spark, [(1, "u", text), (2, "u", "short")]), str(tmp_path / "w"), segment_bytes=1 << 20)
    found = {r.page_id: r for r in warc.read_archives(spark, str(tmp_path / "w")).collect()}
    assert found[1].html == text and found[1].payload_bytes == len(text.encode()) and found[2].html == "short"
