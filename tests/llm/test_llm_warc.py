"""WARC archives: exact round trip."""

import base64
import gzip
import hashlib
import glob
from collections import defaultdict

import pytest

from reelmetrics.llm import warc


def _archive(spark, tmp_path, rows, **options):
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, digest string, holder string")
    path = str(tmp_path / "archive")
    warc.write_archive(pages, path, **options)
    return path, warc.read_archive(spark, path).collect()


ROWS = [
    (1, "http://a/", "<p>one</p>", "x", "y"),
    (2, "http://b/", "<p>one</p>", "x", "y"),
    (2, "http://b/", "<p>one</p>", "x", "y"),
    (3, "http://c/\r\nWARC-Type: metadata", "été\U0001f600", "x", "y"),
    (4, None, None, "x", "y"),
    (5, "http://e/", "", "x", "y"),
    (None, "http://f/", "<p>one</p>", "x", "y"),
    (None, "http://g/", "alone", "x", "y"),
    (6, "http://h/", "z" * 300_000, "x", "y"),
]


def test_round_trip(spark, tmp_path):
    path, found = _archive(spark, tmp_path, ROWS)
    texts = defaultdict(list)
    for i, _, html, *_ in ROWS:
        texts[(html or "").encode()].append(i)
    expected = []
    for payload, ids in texts.items():
        holder = min((i for i in ids if i is not None), default=None)
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        for i in ids:
            kind = ("response", None) if i == holder else ("revisit", holder)
            expected.append((i, payload, len(payload), digest, *kind))
    got = [(r.record_id, bytes(r.payload), r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in found]
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    assert all(r.intact for r in found)
    assert spark.read.parquet(f"{path}/payloads").count() == len(texts)


def test_records_are_well_formed(spark, tmp_path):
    for r in _archive(spark, tmp_path, ROWS)[1]:
        head, block = bytes(r.record).split(b"\r\n\r\n", 1)
        fields = dict(line.split(b": ", 1) for line in head.split(b"\r\n")[1:])
        assert block[-4:] == b"\r\n\r\n" and len(block) - 4 == int(fields[b"Content-Length"])
        assert fields[b"WARC-Type"].decode() == r.record_type
        assert (b"WARC-Target-URI" in fields) == (r.record_id != 4)
        if r.record_type == "response":
            assert block[:-4].endswith(bytes(r.payload))


def test_small_payloads_are_responses(spark, tmp_path):
    _, found = _archive(spark, tmp_path, ROWS, revisit_from=1)
    assert {r.record_type for r in found if not r.payload} == {"response"}
    assert {r.record_id for r in found if r.record_type == "revisit"} == {2, None}


def test_damage_is_seen(spark, tmp_path):
    path, _ = _archive(spark, tmp_path, ROWS)
    from pyspark.sql import functions as F

    spoilt = spark.read.parquet(f"{path}/payloads").withColumn("payload", F.when(F.col("holder") == 1, F.lit(b"two")).otherwise(F.col("payload")))
    spoilt.write.parquet(f"{path}-2/payloads")
    spark.read.parquet(f"{path}/records").write.parquet(f"{path}-2/records")
    damaged = {r.record_id for r in warc.read_archive(spark, f"{path}-2").collect() if not r.intact}
    assert damaged == {1, 2, None}


def test_export_and_empty_table(spark, tmp_path):
    path, found = _archive(spark, tmp_path, ROWS)
    warc.export_warc(warc.read_archive(spark, path), str(tmp_path / "out"))
    written = b"".join(gzip.open(f).read() for f in glob.glob(str(tmp_path / "out/*.gz")))
    assert len(written) == sum(len(r.record) for r in found)
    assert all(bytes(r.record) in written for r in found)
    empty = str(tmp_path / "empty")
    warc.write_archive(spark.createDataFrame([], "page_id bigint, url string, html string"), empty)
    assert warc.read_archive(spark, empty).collect() == []


@pytest.mark.parametrize("payload", [b"", b"abc", "é".encode()])
def test_base32(spark, payload):
    from pyspark.sql import functions as F

    got = spark.range(1).select(warc.base32_sha1(F.lit(payload))).first()[0]
    assert got == base64.b32encode(hashlib.sha1(payload).digest()).decode()
