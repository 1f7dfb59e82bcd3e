import base64
import hashlib

import pytest

from tierlake.llm import warc
from tierlake.session import scratch_path

PAGES = [(3, "http://a/", "x"), (1, None, "x"), (2, "http://b/\r\nInjected: 1", None), (4, "http://c/", ""), (5, "http://d/", "ñ" * 9000),
         (5, "http://d/", "ñ" * 9000), (None, "http://e/", "x"), (7, "http://f/", "\r\nWARC-Type: fake\r\n")]


def table(spark):
    return spark.createDataFrame([(*p, "extra") for p in PAGES], "page_id long, url string, html string, digest string")


def test_round_trip(spark):
    path = scratch_path(spark, "warc_test")
    warc.write_archive(table(spark), path)
    rows = warc.read_index(spark, path).collect()
    assert len(rows) == len(PAGES)
    for r in rows:
        html = next((h or "") for i, _, h in PAGES if i == r["page_id"])
        sha1 = hashlib.sha1(html.encode()).digest()
        assert r["payload_digest"] == base64.b32encode(sha1).decode() and r["payload_bytes"] == len(html.encode())
    kinds = sorted((str(r["page_id"]), r["record_type"], r["refers_to"]) for r in rows)
    assert kinds == sorted([("3", "revisit", 1), ("1", "response", None), ("2", "response", None), ("4", "revisit", 2),
                            ("5", "response", None), ("5", "revisit", 5), ("None", "revisit", 1), ("7", "response", None)])
    assert spark.read.parquet(f"{path}/payloads").count() == 4
    bodies = [bytes(r["record"]) for r in warc.read_records(spark, path).collect()]
    assert sum(b.split(b"\r\n\r\n", 1)[1] == b"x\r\n\r\n" for b in bodies) == 1
    assert all(b.startswith(b"WARC/1.1\r\nWARC-Type: ") for b in bodies)


def test_least_bytes_and_empty(spark):
    path = scratch_path(spark, "warc_test")
    warc.write_archive(table(spark), path, least_bytes=2)
    got = [r["record_type"] for r in warc.read_index(spark, path).collect()]
    assert got.count("revisit") == 1
    path = scratch_path(spark, "warc_test")
    warc.write_archive(table(spark).limit(0), path)
    assert warc.read_index(spark, path).count() == 0


def test_damage_is_found(spark):
    path = scratch_path(spark, "warc_test")
    warc.write_archive(table(spark), path)
    from pyspark.sql import functions as F
    bad = spark.read.parquet(f"{path}/payloads").withColumn("payload", F.lit("no").cast("binary"))
    other = scratch_path(spark, "warc_test")
    bad.write.parquet(f"{other}/payloads")
    spark.read.parquet(f"{path}/records").write.parquet(f"{other}/records")
    with pytest.raises(Exception, match="damaged payload"):
        warc.read_index(spark, other).collect()
