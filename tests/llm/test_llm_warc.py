import gzip
import hashlib

import pytest

from skuflow.llm import warc
from skuflow.session import scratch_path

PAGES = "page_id long, url string, html string, record string, head string"


def round_trip(spark, rows):
    pages = spark.createDataFrame([(*r, "clash", "clash") for r in rows], PAGES)
    path = scratch_path(spark, "warc-test")
    warc.write_warc(pages, path, pages_per_file=3)
    return path, warc.capture_pages(warc.assemble(warc.read_warc(spark, path)))


def brute(rows):
    payload = [(p, (h or "").encode()) for p, _, h in rows]
    first = {}
    for p, b in payload:
        if len(b) >= 100 and p is not None:
            first[b] = min(p, first.get(b, p))
    return sorted(((p, len(b), hashlib.sha256(b).hexdigest(),
                    "revisit" if first.get(b, p) != p else "response",
                    first[b] if first.get(b, p) != p else None) for p, b in payload), key=str)


CASES = {
    "mixed": [(5, "http://a.org/x", "é" * 50), (2, "http://a.org/y", "é" * 50), (9, None, "é" * 50),
              (3, "u", "z" * 99), (4, "u", "z" * 99), (6, "http://b.org", None), (7, "http://b.org", "")],
    "hostile": [(1, "http://c.org/\r\nWARC-Type: response", "a\r\n\r\nWARC/1.1\r\nWARC-Type: x\r\n\r\n" * 9),
                (2, "", "\r\n\r\n" * 60), (3, "x", "\r\n\r\n" * 60), (4, "x", "\x00 and \u2028" * 40)],
    "repeated": [(1, "u", "q" * 200), (1, "u", "q" * 200), (8, "u", "q" * 200), (8, "u", "q" * 200)],
    "null ids": [(None, "u", "r" * 300), (None, "v", "r" * 300), (None, "w", "s" * 300), (4, "w", "s" * 300)],
    "long": [(1, "u", "w" * 3_000_000), (2, "u", "w" * 3_000_000)],
    "empty": [],
}


@pytest.mark.parametrize("case", CASES)
def test_round_trip_equals_brute_force(spark, case):
    _, pages = round_trip(spark, CASES[case])
    got = [tuple(r)[:5] for r in pages.collect()]
    assert sorted(got, key=str) == brute(CASES[case])


def test_payloads_come_back_whole_with_their_request(spark):
    path, _ = round_trip(spark, CASES["mixed"])
    captures = warc.assemble(warc.read_warc(spark, path)).collect()
    assert len(captures) == 7
    for c in captures:
        assert len(c["requests"]) == 1 and len(c["metadata"]) == 1
        if c["record_type"] == "response":
            body = bytes(c["block"]).split(b"\r\n\r\n", 1)[1]
            assert hashlib.sha256(body).hexdigest() == c["payload_digest"] and len(body) == c["payload_bytes"]


def record(kind, own, block, *more):
    head = [f"WARC-Type: {kind}", f"WARC-Record-ID: {own}", *more, f"Content-Length: {len(block)}"]
    return ("WARC/1.1\r\n" + "\r\n".join(head) + "\r\n\r\n").encode() + block + b"\r\n\r\n"


def test_members_and_ties_in_either_direction(spark, tmp_path):
    parts = [record("warcinfo", "<i>", b"software: x"),
             record("response", "<r>", b"HTTP/1.1 200 OK\r\n\r\nbody", "WARC-Concurrent-To: <q>",
                    "Content-Type: application/http"),
             record("request", "<q>", b"GET / HTTP/1.1\r\n\r\n"),
             record("metadata", "<m>", b"a: b\r\n", "WARC-Concurrent-To: <q>", "Content-Type: application/warc-fields"),
             record("metadata", "<orphan>", b"", "WARC-Concurrent-To: <nobody>")]
    (tmp_path / "a.warc.gz").write_bytes(b"".join(gzip.compress(p) for p in parts))
    (tmp_path / "b.warc").write_bytes(record("response", "<s>", b"plain"))
    rows = {c["record_id"]: c for c in warc.assemble(warc.read_warc(spark, str(tmp_path))).collect()}
    assert set(rows) == {"<r>", "<s>"}
    assert [x["record_id"] for x in rows["<r>"]["requests"]] == ["<q>"]
    assert [x["record_id"] for x in rows["<r>"]["metadata"]] == ["<m>"]
    assert rows["<r>"]["payload_bytes"] == 4 and rows["<s>"]["requests"] is None


def test_a_wrong_payload_is_an_error():
    bad = record("response", "<r>", b"x", "WARC-Payload-Digest: sha256:" + "0" * 64)
    with pytest.raises(ValueError, match="digest"):
        list(warc.parse_archive(bad))
