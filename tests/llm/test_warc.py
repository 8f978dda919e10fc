import base64
import gzip
import hashlib
import os

from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, In

from pairloom.llm import warc


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, record_type string, payload string")


def digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


ROWS = [(1, "http://a/1", "<p>é</p>"), (2, "http://a/2", "<p>é</p>"), (3, "http://a/3", None), (4, None, ""), (5, "http://a/5", "x" * 300_000),
        (None, "http://a/n", "<p>é</p>"), (6, "http://a/6\r\nInjected: 1", "y\r\n\r\nz"), (1, "http://a/1", "<p>é</p>")]


def archive(spark, tmp_path, rows=ROWS, **options):
    path = f"file://{tmp_path}/warc"
    warc.write_archive(warc.page_records(pages(spark, [(*r, "t", "p") for r in rows]).repartition(3), **options), path)
    return path


def test_round_trip(spark, tmp_path):
    path = archive(spark, tmp_path)
    back = warc.read_archive(spark, path).where("record_type != 'warcinfo'")
    rows = back.select(warc.page_id("record_id").alias("p"), "payload_length", "payload_digest", "record_type", warc.page_id("refers_to").alias("r"), "payload", "target_uri").collect()
    got = sorted(((r.p, r.payload_length, r.payload_digest, r.record_type, r.r) for r in rows), key=str)
    first = {"<p>é</p>": 1, "": 3, "x" * 300_000: 5, "y\r\n\r\nz": 6}
    want = [(p, len((h or "").encode()), digest(h), "response" if p in (None, first[h or ""]) else "revisit", None if p in (None, first[h or ""]) else first[h or ""]) for p, _, h in ROWS]
    assert got == sorted(want, key=str)
    assert {bytes(r.payload) for r in rows if r.p == 6} == {b"y\r\n\r\nz"}
    assert all(r.payload is None for r in rows if r.record_type == "revisit")


def test_small_payloads_stay_responses(spark, tmp_path):
    path = archive(spark, tmp_path, [(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcd"), (4, "u", "abcd")], min_bytes=3)
    back = warc.read_archive(spark, path).where("record_type = 'revisit'")
    assert [r.record_id for r in back.collect()] == [warc.RECORD.format(4)]


def test_predicates(spark, tmp_path):
    path = archive(spark, tmp_path)
    back = warc.read_archive(spark, path).where((F.col("record_type") == "response") & F.col("target_uri").isin("http://a/5", "http://a/3"))
    assert sorted(r.target_uri for r in back.collect()) == ["http://a/3", "http://a/5"]


def test_header_predicates_are_taken_and_others_left():
    reader = warc.WarcReader({"path": "x"})
    other = EqualTo(("payload_length",), 3)
    assert list(reader.pushFilters([EqualTo(("record_type",), "response"), In(("target_uri",), ("u", "v")), other])) == [other]
    assert reader.filters == [("warc-type", frozenset(["response"])), ("warc-target-uri", frozenset(["u", "v"]))]


def test_pushed_filters_skip_payloads(tmp_path):
    """A payload that is not wanted is not even inflated: the record's body is damaged."""
    good = warc.member(warc.record_bytes({"record_id": "<urn:a>", "record_type": "response", "target_uri": "u", "refers_to": None, "payload": b"ok"}, "2024-01-01T00:00:00Z"))
    bad = bytearray(warc.member(warc.record_bytes({"record_id": "<urn:b>", "record_type": "response", "target_uri": "v", "refers_to": None, "payload": os.urandom(60_000)}, "2024-01-01T00:00:00Z")))
    bad[-2000:-1000] = bytes(1000)
    p = tmp_path / "x.warc.gz"
    p.write_bytes(bytes(bad) + good)
    system, path = warc.file_system(str(p))
    with system.open_input_file(path) as f:
        rows = list(warc.records(f, True, [("warc-target-uri", frozenset(["u"]))], True, True))
    assert [r[-1] for r in rows] == [b"ok"]


def test_a_second_archive_is_added(spark, tmp_path):
    archive(spark, tmp_path, [(1, "http://a/1", "one"), (2, "http://a/2", "two")])
    path = archive(spark, tmp_path, [(3, "http://a/3", "three")])
    back = warc.read_archive(spark, path).where("record_type != 'warcinfo'")
    assert sorted(bytes(r.payload) for r in back.collect()) == [b"one", b"three", b"two"]


def test_other_writers_files(spark, tmp_path):
    record = warc.record_bytes({"record_id": "<urn:a>", "record_type": "response", "target_uri": "u", "refers_to": None, "payload": b"p" * 20_000}, "2024-01-01T00:00:00Z")
    folder = tmp_path / "w"
    folder.mkdir()
    (folder / "a.warc.gz").write_bytes(gzip.compress(record) * 3)
    (folder / "b.warc").write_bytes(record * 2)
    rows = warc.read_archive(spark, str(folder)).collect()
    assert [len(r.payload) for r in rows] == [20_000] * 5


def test_no_pages(spark, tmp_path):
    assert warc.read_archive(spark, archive(spark, tmp_path, [])).collect() == []
