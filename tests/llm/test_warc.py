"""Archives are written, read back and compared."""

import base64
import hashlib

from procurelytics.llm import warc

SCHEMA = "page_id long, url string, html string, row string"


def rows(spark, data, **kw):
    return {r["page_id"]: r for r in warc.warc_rows(spark.createDataFrame(data, SCHEMA), **kw).collect()}


def digest(text):
    return base64.b32encode(hashlib.sha1(text.encode()).digest()).decode()


def test_round_trip_of_awkward_payloads(spark, monkeypatch):
    monkeypatch.setattr(warc, "CHUNK_CHARS", 50)
    version = warc.VERSION
    texts = ["", None, "a", "é\r\n\r\n" * 40, version * 30, "x" * 42 + "WARC/1.1", "x" * 49 + version, "a", "\r\n", "WARC/1.1", version + "a", "😀" * 120]
    got = rows(spark, [(i, None if i == 2 else f"http://h/{i}?\r\nWARC/1.1", t, "own") for i, t in enumerate(texts)])
    assert len(got) == len(texts)
    first = {}
    for i, t in enumerate(texts):
        t = t or ""
        f = first.setdefault(t, i)
        assert (got[i]["payload_bytes"], got[i]["payload_digest"]) == (len(t.encode()), digest(t)), i
        assert (got[i]["record_type"], got[i]["refers_to"]) == (("response", None) if f == i else ("revisit", f)), i


def test_repeated_ids_missing_ids_and_empty_table(spark):
    got = rows(spark, [(1, "u", "b", ""), (1, "u", "a", ""), (None, "u", "c", ""), (-5, "u", "a", "")])
    assert set(got) == {1, -5} and got[1]["payload_digest"] == digest("a") and got[1]["refers_to"] == -5
    assert rows(spark, []) == {}


def test_segments_are_bounded_and_standard(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "CHUNK_CHARS", 10)
    path = str(tmp_path / "w")
    warc.write_archives(spark.createDataFrame([(1, "u", "0123456789" * 3, "")], SCHEMA), path)
    parts = warc.read_segments(spark, path).orderBy("chunk_no").collect()
    assert [bytes(p["chunk"]) for p in parts] == [b"0123456789"] * 3 and [p["last"] for p in parts] == [False, False, True]
    assert [p["record_type"] for p in parts] == ["response", "continuation", "continuation"]


def test_small_payloads_are_responses(spark, tmp_path):
    path = str(tmp_path / "w")
    warc.write_archives(spark.createDataFrame([(1, "u", "ab", ""), (2, "u", "ab", ""), (3, "u", "long", ""), (4, "u", "long", "")], SCHEMA), path, min_payload=3)
    assert {r["row"]: r["record_type"] for r in warc.read_records(spark, path).collect()} == {1: "response", 2: "response", 3: "response", 4: "revisit"}


def test_texts_without_the_version_are_not_searched_for_it(spark, monkeypatch):
    monkeypatch.setattr(warc, "_INSIDE", "(")  # no pattern: it fails where it is used
    df = spark.createDataFrame([(1, "a" * 100), (2, "é"), (3, ""), (4, None)], "row long, html string")
    monkeypatch.setattr(warc, "CHUNK_CHARS", 40)
    got = sorted((r["row"], r["chunk_no"], r["chunk"], r["last"]) for r in warc.chunk_table(df, "row", "html").collect())
    assert got == [(1, 0, "a" * 40, False), (1, 1, "a" * 40, False), (1, 2, "a" * 20, True), (2, 0, "é", True), (3, 0, "", True), (4, 0, "", True)]
