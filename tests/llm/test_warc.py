import base64
import hashlib
import io

import pytest

from regain.llm import warc

SCHEMA = "page_id long, url string, html string, digest string, key int"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA)


def brute(rows):
    first = {}
    for key, _, html in rows:
        body = html or ""
        if key is not None:
            first[body] = min(first.get(body, key), key)
    out = []
    for key, _, html in rows:
        raw = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        again = first.get(html or "", key) != key
        out.append((key, len(raw), digest, "revisit" if again else "response", first[html or ""] if again else None))
    return sorted(out, key=str)


def run(df, work, **more):
    return sorted((tuple(r) for r in warc.archive_pages(df, work, **more).collect()), key=str)


def test_round_trip(spark, work):
    rows = [(i, f"http://h{i}.org/a b\n{i}", f"<p>é{i % 7}</p>\r\n\r\nWARC/1.1\r\n\r\n\n{'y' * i}" if i % 3 else "same") for i in range(90)]
    rows += [(200, None, None), (201, "", ""), (202, "u", None), (203, "http://x/", "z" * 300000)]
    df = pages(spark, rows).repartition(5)
    assert run(df, work) == brute(rows)


def test_files_hold_bounded_numbers_of_records(spark, work, monkeypatch):
    monkeypatch.setattr(warc, "RECORDS_PER_FILE", 8)
    rows = [(i, "http://h/", f"body {i}") for i in range(60)]
    assert run(pages(spark, rows).coalesce(1), work) == brute(rows)


def test_repeated_rows_null_keys_and_empty_tables(spark, work):
    got = run(pages(spark, [(3, "u", "a"), (3, "u", "a"), (None, "u", "a"), (None, "v", "b")]), work)
    assert sorted(str((r[0], r[3], r[4])) for r in got) == [
        "(3, 'response', None)", "(3, 'revisit', 3)", "(None, 'response', None)", "(None, 'revisit', 3)",
    ]
    assert run(pages(spark, []), work) == []


def test_small_payloads_stay_responses(spark, work):
    rows = [(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcdef"), (4, "u", "abcdef")]
    assert [r[3] for r in run(pages(spark, rows), work, min_bytes=3)] == ["response", "response", "response", "revisit"]


ARC_1 = (
    b"filedesc://old.arc 0.0.0.0 19970101000000 text/plain 71\n1 0 Someone\n"
    b"URL IP-address Archive-date Content-type Archive-length\n\n\n\n"
    b"http://a.org/ 1.2.3.4 19970102030405 text/html 27\nHTTP/1.0 200 OK\nA: b\n\nhello\n"
    b"dns:a.org 5.6.7.8 199701 text/dns 4\n\n\nxy\n"
)
ARC_2 = (
    b"filedesc://new.arc 0.0.0.0 20000101000000 text/plain 200 - - 0 new.arc 121\n2 0 Someone\n"
    b"URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length\n\n\n\n\n\n\n\n"
    b"http://b.org/ 1.2.3.4 20000102030405 text/html 200 - - 0 new.arc 3\n\r\n!\n"
)


def test_both_versions_are_parsed_by_their_own_lines():
    one = list(warc.read_arc(io.BytesIO(ARC_1), "old.arc"))
    assert [(r["URL"], r["Archive-date"], r["content"]) for r in one] == [
        ("http://a.org/", "19970102030405", b"HTTP/1.0 200 OK\nA: b\n\nhello"), ("dns:a.org", "199701", b"\n\nxy"),
    ]
    assert warc.split_http(one[0]["content"]) == (b"HTTP/1.0 200 OK\nA: b\n\n", b"hello")
    assert warc.split_http(one[1]["content"]) == (b"", b"\n\nxy")
    (two,) = warc.read_arc(io.BytesIO(ARC_2), "new.arc")
    assert two["Result-code"] == "200" and two["content"] == b"\r\n!"


@pytest.mark.parametrize("bad", [
    ARC_1[:-4], ARC_1.replace(b"1 0 Some", b"9 0 Some"), ARC_2.replace(b"new.arc 3", b"new.arc"), b"http://no.block/ 1 2 3 4\n",
])
def test_broken_archives_fail(bad):
    with pytest.raises(ValueError):
        list(warc.read_arc(io.BytesIO(bad), "bad.arc"))
    assert list(warc.read_arc(io.BytesIO(b""), "empty.arc")) == []


def test_fields():
    assert warc.warc_date("19970102030405") == "1997-01-02T03:04:05Z" and warc.warc_date("1997") == "1997-01-01T00:00:00Z"
    assert warc.record_id("a", 1) == warc.record_id("a", 1) != warc.record_id("a", 2)
    assert warc.safe_url("a b\n") == "a%20b%0A" and warc.safe_url(None) == "-"


def test_archives_are_written_at_the_level_that_is_set(spark, tmp_path, monkeypatch):
    """The default level took more than half of the CPU time before."""
    table = spark.createDataFrame([(i, f"http://a.org/{i}", "<p>much the same text</p>" * 40) for i in range(200)], "page_id long, url string, html string")
    sizes = {}
    for level in (warc.GZIP_LEVEL, "NO_COMPRESSION"):
        monkeypatch.setattr(warc, "GZIP_LEVEL", level)
        warc.write_arc(table.coalesce(1), f"file://{tmp_path}/{level}")
        sizes[level] = sum(f.stat().st_size for f in (tmp_path / level).glob("*.gz"))
    assert sizes["NO_COMPRESSION"] > 5 * sizes["THREE"]
