from __future__ import annotations

import base64
import gzip
import hashlib

import pytest
from pyspark.sql import functions as F

from keyfold.llm import queries, warc
from keyfold.llm.common import workers_find_package

PAGES = [(1, "http://a.org/x", "same"), (2, None, "same"), (5, "no scheme\r\nX: y", "same"), (3, "http://b.org", None), (4, "http://b.org", ""),
         (6, "http://é.org/ü", "größe 東京 \U0001f600"), (7, "u", "z" * 200_000), (7, "u", "z" * 200_000), (None, "v", "alone"), (None, "v", "same")]


@pytest.fixture(scope="module")
def pages(spark):
    workers_find_package(spark)
    return spark.createDataFrame([(*p, 1, "b") for p in PAGES], "page_id long, url string, html string, record_type int, payload string").repartition(2)


def result(df):
    return df.select(warc.page_number("record_id").alias("page_id"), "record_type", warc.page_number("refers_to").alias("refers_to"),
                     "payload_bytes", "payload_digest", F.col("payload").cast("string").alias("text"))


def test_round_trip(spark, pages):
    got = sorted((tuple(r) for r in result(warc.roundtrip(pages)).collect()), key=str)
    expected = []
    for page, _, html in PAGES:
        data = (html or "").encode()
        group = [p for p, _, h in PAGES if (h or "") == (html or "") and p is not None]
        first = max(group) if len([1 for _, _, h in PAGES if (h or "") == (html or "")]) > 1 and group else None
        again = first is not None and page != first
        digest = "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()
        expected.append((page, "revisit" if again else "response", first if again else None, len(data), digest, "" if again else html or ""))
    assert got == sorted(expected, key=str)


def test_empty_table(spark, pages):
    assert warc.roundtrip(pages.where("false")).count() == 0


def test_filters_are_pushed_and_payloads_left_out(spark, pages, tmp_path):
    path = f"file://{tmp_path}/w"
    warc.write_archives(warc.as_records(pages), path)
    some = warc.read_archives(spark, path).where("record_type = 'revisit' and payload_bytes > 0")
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "Filter" not in plan.replace("PushedFilters", "").split("BatchScan")[0]
    assert {r.record_type for r in some.collect()} == {"revisit"}
    assert warc.read_archives(spark, path, payload=False).where("payload is not null").count() == 0
    assert warc.read_archives(spark, path).where("target_uri like 'http://b%' and record_type <> 'revisit'").count() == 1


def test_foreign_archives(spark, tmp_path):
    """Plain archives, and gzip members without a length."""
    record = warc.record_bytes({"record_type": "response", "record_id": "<urn:x-page:9>"}, b"hello", 5)
    (tmp_path / "a.warc").write_bytes(record * 3)
    (tmp_path / "b.warc.gz").write_bytes(gzip.compress(record) + gzip.compress(record.replace(b"hello", b"olleh")))
    rows = warc.read_archives(spark, f"file://{tmp_path}").collect()
    assert sorted(bytes(r.payload) for r in rows) == [b"hello"] * 4 + [b"olleh"]


def test_damage_is_reported(spark, pages, tmp_path):
    record = warc.record_bytes({"record_type": "response", "record_id": "<urn:x-page:9>", "payload_digest": "sha1:AAAA"}, b"hello", 5)
    (tmp_path / "a.warc.gz").write_bytes(warc.member(record))
    with pytest.raises(Exception, match="doesn't match its digest"):
        warc.read_archives(spark, f"file://{tmp_path}", verify=True).collect()


def test_members_are_plain_gzip():
    assert gzip.decompress(warc.member(b"abc" * 1000)) == b"abc" * 1000


def test_query(spark):
    assert queries.QUERIES["op1_warc"](spark, "/root/testdata/sf0.001").columns == [
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]


def test_a_second_write_adds_and_overwrite_replaces(spark, pages, tmp_path):
    path = f"file://{tmp_path}/w"
    records = warc.as_records(pages)
    warc.write_archives(records, path)
    warc.write_archives(records.where("target_uri = 'v'"), path)
    assert warc.read_archives(spark, path).count() == len(PAGES) + 2
    records.where("target_uri = 'v'").write.format("warc").option("path", path).mode("overwrite").save()
    assert warc.read_archives(spark, path).count() == 2


def test_a_write_that_failed_is_not_read(spark, pages, tmp_path):
    """What tasks wrote before a job failed is deleted as far as they had ended, and never read."""
    path = str(tmp_path / "failed")
    batch = warc.as_records(pages).toArrow().to_batches()
    done = warc.Writer(path, 1 << 20).write(iter(batch))
    left = warc.Writer(path, 1 << 20).write(iter(batch))  # a task whose end the driver never heard of
    assert warc.read_archives(spark, path).count() == 0
    warc.Writer(path, 1 << 20).abort([done, None])
    names = {p.name for p in (tmp_path / "failed").iterdir()}
    assert not names & set(done.names) and names >= set(left.names)
    assert warc.read_archives(spark, path).count() == 0
    warc.write_archives(warc.as_records(pages), path)
    assert warc.read_archives(spark, path).count() == len(PAGES)
