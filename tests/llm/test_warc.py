import base64
import gzip
import hashlib
import os

import pyarrow.fs as pafs
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from oracle_compare import compare, duck
from rivulet.llm import warc
from rivulet.session import scratch_dir


def test_query_matches_sql(spark):
    r = compare(warc.op1_warc(spark, SF_SMALL), duck(SF_SMALL), warc.SQL)
    assert r["hash_match"], r


def run(spark, rows, min_bytes=0, tmp=None):
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, payload string, sha1 string")
    folder = str(tmp) + "/in"
    os.makedirs(folder, exist_ok=True)
    pages.write.mode("overwrite").parquet(folder + "/pages.parquet")
    out = warc.op1_warc(spark, folder, min_bytes).collect()
    return sorted([(r.page_id is None, r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)
                   for r in out], key=str)


def digest(text):
    return base64.b32encode(hashlib.sha1(text.encode()).digest()).decode()


def test_nulls_ties_repeats_and_clashing_names(spark, tmp_path):
    rows = [(1, "u", "x", "p", "s"), (2, None, "x", None, None), (3, "u\r\nInjected: 1", "ü", None, None),
            (4, "u", None, None, None), (5, "u", "", None, None), (None, "u", "x", None, None),
            (7, "u", "z" * 3_000_000, None, None), (8, "u", "q", None, None), (8, "u", "q", None, None)]
    got = run(spark, rows, tmp=tmp_path)
    plain = [g[1:] for g in got]
    assert (1, 1, digest("x"), "revisit", 2) in plain
    assert (2, 1, digest("x"), "response", None) in plain
    assert (None, 1, digest("x"), "revisit", 2) in plain
    assert (3, 2, digest("ü"), "response", None) in plain
    assert (4, 0, digest(""), "revisit", 5) in plain and (5, 0, digest(""), "response", None) in plain
    assert (7, 3_000_000, digest("z" * 3_000_000), "response", None) in plain
    eights = sorted(g[3:] for g in plain if g[0] == 8)
    assert eights == [("response", None), ("revisit", 8)]
    assert len(got) == len(rows)


def test_small_payloads_are_all_responses(spark, tmp_path):
    got = run(spark, [(1, "u", "x", "", ""), (2, "u", "x", "", ""), (3, "u", "xy", "", ""), (4, "u", "xy", "", "")],
              min_bytes=2, tmp=tmp_path)
    assert [(g[1], g[4], g[5]) for g in got] == [(1, "response", None), (2, "response", None), (3, "revisit", 4),
                                                 (4, "response", None)]


def test_empty_table(spark, tmp_path):
    assert run(spark, [], tmp=tmp_path) == []


@pytest.mark.parametrize("step", [1, 97, 4096, 10**9])
def test_every_range_split_gives_every_record_once(tmp_path, step):
    data, n = b"", 12
    for i in range(n):
        payload = os.urandom(137 * i) + warc.MAGIC + b"x"
        data += warc.gzip_member(warc.render(f"urn:{i}", "response", "u", None, hashlib.sha1(payload).hexdigest(),
                                             payload))
    path = tmp_path / "a.warc.gz"
    path.write_bytes(data)
    assert gzip.decompress(data).count(b"WARC/1.1\r\n") == n
    with pafs.LocalFileSystem().open_input_file(str(path)) as file:
        found = [r[2]["record_id"] for s in range(0, len(data), step)
                 for r in warc.records_in(warc._Window(file, len(data)), s, min(len(data), s + step))]
    assert found == [f"urn:{i}" for i in range(n)]


@pytest.mark.parametrize("step", [50_000, 10**9])
def test_header_blocks_have_no_largest_length(tmp_path, step):
    uri = "http://a/" + os.urandom(1_500_000).hex()
    data = b"".join(warc.gzip_member(warc.render(f"urn:{i}", "response", u, None, "00" * 20, b"x"))
                    for i, u in enumerate(["u", uri, "v"]))
    path = tmp_path / "h.warc.gz"
    path.write_bytes(data)
    with pafs.LocalFileSystem().open_input_file(str(path)) as file:
        found = [r[2]["target_uri"] for s in range(0, len(data), step)
                 for r in warc.records_in(warc._Window(file, len(data)), s, min(len(data), s + step))]
    assert found == ["u", uri, "v"]


def test_records_cross_read_blocks_and_nested_archives_are_dropped(spark, tmp_path, monkeypatch):
    inner = warc.gzip_member(warc.render("urn:inner", "response", "u", None, "00" * 20, b"hidden"))
    outer = warc.gzip_member(warc.render("urn:outer", "response", "u", None, "00" * 20, b"A" * 500 + inner), level=0)
    after = warc.gzip_member(warc.render("urn:after", "response", "u", None, "00" * 20, b"B"))
    path = str(tmp_path / "n.warc.gz")
    with open(path, "wb") as f:
        f.write(outer + after)
    manifest = spark.createDataFrame([(path, len(outer + after))], "path string, bytes long")
    read = warc.read_warc(manifest, range_bytes=64).drop("payload")
    assert {r.record_id for r in read.collect()} == {"urn:outer", "urn:inner", "urn:after"}
    assert {r.record_id for r in warc.drop_nested(read).collect()} == {"urn:outer", "urn:after"}
    monkeypatch.setattr(warc, "READ_BYTES", 7)
    with pafs.LocalFileSystem().open_input_file(path) as file:
        assert [r[2]["record_id"] for r in warc.records_in(warc._Window(file, len(outer + after)), 0, 10**9)] == [
            "urn:outer", "urn:after"]


def test_files_of_lost_attempts_and_broken_tails_are_not_read(spark):
    folder = scratch_dir(spark, "warc-test")
    rows = spark.createDataFrame([("urn:a", "response", "u", None, "00" * 20, bytearray(b"abc"))],
                                 "record_id string, record_type string, target_uri string, refers_to string, "
                                 "sha1 string, payload binary")
    manifest = warc.write_warc(rows, folder)
    with open(folder.removeprefix("file:") + "/other.warc.gz", "wb") as f:
        f.write(warc.gzip_member(warc.render("urn:b", "response", "u", None, "00" * 20, b"abc")))
    got = warc.read_warc(manifest).collect()
    assert [(r.record_id, bytes(r.payload)) for r in got] == [("urn:a", b"abc")]
    cut = manifest.withColumn("bytes", F.col("bytes") - 5)
    assert warc.read_warc(cut).count() == 0


def test_file_size_rolls_over(spark):
    rows = spark.range(40).repartition(1).select(
        F.concat(F.lit("urn:"), "id").alias("record_id"), F.lit("response").alias("record_type"),
        F.lit("u").alias("target_uri"), F.lit(None).cast("string").alias("refers_to"),
        F.sha1(F.col("id").cast("string").cast("binary")).alias("sha1"),
        F.repeat(F.sha2(F.col("id").cast("string").cast("binary"), 256), 50).cast("binary").alias("payload"))
    manifest = warc.write_warc(rows, scratch_dir(spark, "warc-test"), file_bytes=2000)
    assert manifest.count() > 1 and manifest.agg(F.sum("records")).first()[0] == 40
    assert warc.read_warc(manifest).select("record_id").distinct().count() == 40
