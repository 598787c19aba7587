import gzip
import hashlib
import io

import pytest

from topictables.llm import warc
from topictables.llm.common import shared_folder

SCHEMA = "page_id long, url string, html string, digest string, record_id int"
LONG = "<p>" + "ü" * 60 + "</p>\r\n\r\nWARC/1.1\r\n\r\nmore"


def test_round_trip(spark):
    rows = [(5, "http://a/x y", LONG), (3, "http://a/\r\nx", LONG), (9, "http://b", LONG), (1, "http://c", "short"), (2, "http://d", "short"), (4, None, None), (6, "", ""), (7, "http://e", "z" * 99), (8, "http://f", "z" * 99), (10, "http://g", "q" * 100), (11, "http://h", "q" * 100), (12, "u", "rep" * 50), (12, "u", "rep" * 50)]
    rows += [(None, "http://n", LONG), (13, "http://i", "\n\n" * 80 + "\r\n\r\n")]
    path = shared_folder(spark)
    warc.write(spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(3), path)
    found = warc.transactions(warc.read(spark, path)).collect()
    assert len(found) == len(rows)
    payloads = {(r[0], (r[2] or "").encode()) for r in rows}
    by_id = {}
    for f in found:
        capture = f["capture"]
        key = capture["record_id"].split(":")[2]
        by_id.setdefault(int(key) if key else None, []).append(capture)
        assert f["request"]["payload"] == b""
        notes = {e["key"]: e["value"] for e in f["metadata"][0]["fields"]}
        if capture["type"] == "response":
            assert (int(key) if key else None, bytes(capture["payload"])) in payloads
            assert capture["payload_digest"] == hashlib.sha256(capture["payload"]).hexdigest()
            assert capture["declared_digest"] == "sha256:" + capture["payload_digest"]
            assert int(notes["payload-length"]) == len(capture["payload"])
        else:
            assert capture["payload"] == b""
    kinds = {k: [c["type"] for c in v] for k, v in by_id.items()}
    assert kinds == {3: ["response"], 5: ["revisit"], 9: ["revisit"], 1: ["response"], 2: ["response"], 4: ["response"], 6: ["response"], 7: ["response"], 8: ["response"], 10: ["response"], 11: ["revisit"], 12: ["response"] * 2, 13: ["response"], None: ["revisit"]}
    assert all(c["refers_to"].split(":")[2] == "3" for k in (5, 9, None) for c in by_id[k])


def test_no_pages(spark):
    path = shared_folder(spark)
    warc.write(spark.createDataFrame([], SCHEMA), path)
    assert warc.transactions(warc.read(spark, path)).count() == 0


def record(kind, name, concurrent="", block=b"", content="application/http"):
    head = f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Record-ID: {name}\r\n"
    head += f"WARC-Concurrent-To: {concurrent}\r\n" if concurrent else ""
    return (head + f"Content-Type: {content};\r\n msgtype=x\r\nContent-Length: {len(block)}\r\n\r\n").encode() + block + b"\r\n\r\n"


def test_archives_of_others(spark, tmp_path):
    """Records compressed one by one, binary payloads, folded headers, lone records, several metadata."""
    first = [record("warcinfo", "<i>", content="application/warc-fields", block=b"software: x\r\n"), record("response", "<r>", block=b"HTTP/1.1 200 OK\r\nA: b\r\n\r\n\xff\x00\r\n\r\n"), record("metadata", "<m2>", "<r>", b"b: 2\r\n", "application/warc-fields")]
    (tmp_path / "a.warc.gz").write_bytes(b"".join(map(gzip.compress, first)))
    second = [record("request", "<q>", "<r>", b"GET / HTTP/1.1\r\n\r\n"), record("metadata", "<m1>", "<r>", b"a: 1\r\n", "application/warc-fields"), record("request", "<lost>", "<none>"), record("response", "<alone>")]
    (tmp_path / "b.warc").write_bytes(b"".join(second))
    found = {r["capture"]["record_id"]: r for r in warc.transactions(warc.read(spark, str(tmp_path))).collect()}
    assert set(found) == {"<r>", "<alone>"}
    assert bytes(found["<r>"]["capture"]["payload"]) == b"\xff\x00\r\n\r\n"
    assert found["<r>"]["request"]["record_id"] == "<q>"
    assert [m["id"] for m in found["<r>"]["metadata"]] == ["<m1>", "<m2>"]
    assert found["<alone>"]["request"] is None and found["<alone>"]["metadata"] == []


def test_broken_archives():
    with pytest.raises(ValueError, match="not a WARC"):
        list(warc.parse(io.BytesIO(b"<html>")))
    with pytest.raises(ValueError, match="ends before"):
        list(warc.parse(io.BytesIO(record("response", "<r>", block=b"x" * 9)[:-8])))


def test_large_captures_lie_in_files_of_their_own(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "FILE_RECORDS", ((50, 60), (1000, 9), (None, 3)))
    sizes = [10] * 100 + [500] * 20 + [5000] * 4
    rows = [(i, f"http://x/{i}", chr(97 + i % 26) * n + str(i)) for i, n in enumerate(sizes)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    path = str(tmp_path / "w")
    warc.write(df, path)
    counts = {}
    for file in (tmp_path / "w").rglob("*.gz"):
        records = list(warc.parse(io.BufferedReader(gzip.GzipFile(file))))
        largest = max(len(block) for _, block in records)
        counts.setdefault(file.parent.name, []).append(len(records))
        assert len(records) <= {"0": 60, "1": 9, "2": 3}[file.parent.name]
        assert file.parent.name == "2" or largest < 5000
    assert {k: sum(v) for k, v in counts.items()} == {"0": 300, "1": 60, "2": 12}
    assert warc.transactions(warc.read(spark, path)).count() == len(rows)
