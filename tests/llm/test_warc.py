import glob
import gzip
import hashlib
import io

from hushline.llm import warc


def want(pages):
    latest = {}
    for page, url, html in pages:
        if len((html or "").encode()) >= 1000:
            latest[html] = max(latest.get(html, (-1, "")), (-1 if page is None else page, url or ""))
    out = []
    for page, url, html in pages:
        b, o = (html or "").encode(), latest.get(html)
        first = o is None or o == (-1 if page is None else page, url or "")
        out.append((page, len(b), hashlib.sha1(b).hexdigest(), "response" if first else "revisit", None if first else o[0]))
    return sorted(out, key=str)


def test_round_trip_with_odd_pages(spark):
    big, tricky = "x" * 1000, "a\r\n\r\nWARC/1.1\r\nb é😀\r\n\r\n" * 100
    pages = [(i, f"http://h/{i}", f"<p>{i}</p>" * (i * 3)) for i in range(120)]
    pages += [(200 + i, "http://h/copy", big) for i in range(40)] + [(300 + i, None, tricky) for i in range(3)]
    pages += [(400, "u", "x" * 999), (401, "u", "x" * 999), (None, None, None), (None, "u", big), (402, "a\r\nb", ""), (403, "", tricky)]
    pages += [pages[5], pages[100], pages[159]]  # repeated rows, the last a response
    df = spark.createDataFrame([(*p, i) for i, p in enumerate(pages)], "page_id long, url string, html string, n int")
    assert sorted(map(tuple, warc.archive_round_trip(df).collect()), key=str) == want(pages)
    assert warc.archive_round_trip(df.limit(0)).collect() == []


def test_archives_are_plain_warc(spark, tmp_path):
    df = spark.createDataFrame([(1, "http://h/é", "y" * 1000), (2, "http://h/2", "y" * 1000)], "page_id long, url string, html string")
    path = str(tmp_path / "out")
    warc.write_archives(df, path)
    records = []
    for name in glob.glob(path + "/part-*"):
        with gzip.open(name) as f:
            records += warc.parse_archive(io.BufferedReader(f))
    assert sorted(f["warc-type"] for f, _ in records) == ["metadata"] * 2 + ["request"] * 2 + ["response", "revisit"]
    assert len({f["warc-record-id"] for f, _ in records}) == 6
    (revisit,) = (f for f, _ in records if f["warc-type"] == "revisit")
    (response,) = (f for f, _ in records if f["warc-type"] == "response")
    assert revisit["warc-refers-to"] == response["warc-record-id"] and response["warc-target-uri"] == "http://h/2"
    got = {r["capture_id"]: r for r in warc.captures(warc.read_archives(spark, path)).collect()}
    assert got[response["warc-record-id"]]["metadata"]["fields"] == {"page_id": "2"}
    assert got[revisit["warc-record-id"]]["request"]["target_uri"] == "http://h/é"


def test_captures_without_response_stay(spark):
    rows = [("r1", "request", "lost", None, None, None, None, None, {})]
    (got,) = warc.captures(spark.createDataFrame(rows, warc.RECORD)).collect()
    assert got["response"] is None and got["request"]["record_id"] == "r1"
