import hashlib

from pyspark.sql import functions as F

from parcelflow.llm import warc


def _pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, block string, record_id string")


def test_round_trip_with_revisits(spark):
    long, tricky = "x" * 1200, "é" * 600 + "\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n"
    rows = [(1, "http://a b/c", long), (2, None, long), (2, "u", long), (None, "u", long), (5, "u", None), (6, "u", tricky),
            (7, "u", tricky), (8, "u", "ab"), (9, "u", "ab")]
    got = warc.archive_pages(_pages(spark, [(*r, None, "id") for r in rows])).collect()
    assert sorted((str(r.page_id), r.payload_bytes, r.payload_digest) for r in got) == sorted(
        (str(i), len((h or "").encode()), hashlib.sha1((h or "").encode()).hexdigest()) for i, _, h in rows
    )
    kinds = sorted(((str(r.page_id), r.record_type, r.refers_to) for r in got), key=str)
    assert kinds == sorted(
        [("1", "revisit", 2), ("2", "response", None), ("2", "revisit", 2), ("None", "revisit", 2), ("5", "response", None),
         ("6", "revisit", 7), ("7", "response", None), ("8", "response", None), ("9", "response", None)],
        key=str,
    )
    assert [k[1] for k in kinds].count("revisit") == 4


def test_empty_table(spark):
    assert warc.archive_pages(_pages(spark, [])).count() == 0


def test_both_arc_versions_and_bad_lines():
    one = b"filedesc://a 0.0.0.0 20260101000000 text/plain 73\n1 0 org\nURL IP-address Archive-date Content-type Archive-length\n" + b" " * 9
    body = b"HTTP/1.1 200 OK\r\nX-Page-Id: 4\r\n\r\npayload"
    head = b"http://x y/z 1.2.3.4 20260102030405 text/html %d\n" % len(body)
    data = one + b"\nnonsense line\n" + head + body + b"\n" + head[:-1].replace(b"%d" % len(body), b"99") + b"\n" + body
    records = list(warc.arc_records(data))
    assert [r.fields["URL"] for r in records] == ["filedesc://a", "http://x y/z", "http://x y/z"]
    assert [r.truncated for r in records] == [False, False, True]
    row = warc.convert_record("f", records[1])
    assert row[1:4] == ("response", "2026-01-02T03:04:05Z", "http://x y/z") and row[7:9] == (4, 7)
    assert warc.convert_record("f", records[0])[1] == "warcinfo"
    fields = warc.ARC_FIELDS[2]
    about = f"2 0 org\n{fields}\n".encode()
    two = b"filedesc://b 0.0.0.0 20260101 text/plain %d\n" % len(about) + about + b"\nhttp://q 1.1.1.1 20260101 text/html 200 - - 0 b.arc 3\nabc\n"
    got = list(warc.arc_records(two))
    assert got[1].fields["Result-code"] == "200" and got[1].block == b"abc"
    assert warc.convert_record("f", got[1])[1:3] == ("resource", "2026-01-01T00:00:00Z".replace("T", "T"))


def test_base32(spark):
    import base64

    digest = hashlib.sha1(b"a").hexdigest()
    got = spark.range(1).select(warc.base32(F.lit(digest)).alias("x")).first().x
    assert got == base64.b32encode(bytes.fromhex(digest)).decode()


def test_records_of_alike_archives_have_their_own_ids(spark, scratch, monkeypatch):
    """Many archives written by few tasks, every page with a null URL."""
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 4000)
    rows = [(i, None, f"{i:04d}" + "x" * 1196, None, "id") for i in range(120)]
    rows += [(1000 + i, None, "y" * 1200, None, "id") for i in range(40)]
    pages = _pages(spark, rows)
    warc.write_arc(pages.coalesce(1), f"{scratch}/arc")
    ids = [r.record_id for r in warc.convert_arc(spark, f"{scratch}/arc").select("record_id").collect()]
    assert len(ids) > 160 and len(set(ids)) == len(ids)
    got = sorted((r.page_id, r.record_type, r.refers_to) for r in warc.archive_pages(pages).collect())
    assert got == [(i, "response", None) for i in range(120)] + [(1000 + i, "revisit", 1039) for i in range(39)] + [(1039, "response", None)]


def test_pages_whose_url_looks_like_a_version_block(spark):
    rows = [(i, ["filedesc:x", "filedesc://x.arc", "http://h/%d" % i][i % 3], f"<p>{i}</p>\n1 0 a\nb c d e f", None, "id") for i in range(30)]
    got = warc.archive_pages(_pages(spark, rows)).collect()
    assert sorted((r.page_id, r.record_type, r.payload_bytes) for r in got) == [(i, "response", len(h)) for i, _, h, _, _ in rows]


def test_pages_of_one_url_spread_over_the_archives(spark, scratch, monkeypatch):
    """Null ids and one URL: archives stay near their size, and each is one file of one task."""
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 20_000)
    pages = _pages(spark, [(None, "http://hot/", f"{i:05d}" * 200, None, "id") for i in range(400)])
    warc.write_arc(pages, f"{scratch}/even")
    files = spark.read.text(f"{scratch}/even", wholetext=True).select("archive", F.length("value").alias("n"), F.input_file_name().alias("f")).collect()
    assert len(files) == warc.archive_count(pages) == len({r.archive for r in files}) == len({r.f.split("part-")[1] for r in files})
    assert max(r.n for r in files) < 2 * warc.ARCHIVE_BYTES
