import hashlib

import pytest

from quarry.llm import warc
from quarry.llm.common import scratch_path

SCHEMA = "page_id long, url string, html string, shard string, kind string"


def pages(spark):
    big, other = "ä" * 600, "b" * 1200
    rows = [(i, f"http://x/{i}", big) for i in range(0, 60, 2)] + [(i, None, other) for i in range(1, 9, 2)]
    rows += [(100, "http://y z\r\n", None), (101, "u", ""), (102, "u", "small"), (103, "u", "small"), (None, "n", other),
             (7, None, other), (104, "u", "c" * 999), (105, "u", "c" * 999), (106, "u", "long" * 300_000)]
    return spark.createDataFrame([(*r, "s", "k") for r in rows], SCHEMA), rows


def test_round_trip_and_revisits(spark):
    df, rows = pages(spark)
    path = scratch_path(spark, "t")
    manifest = warc.write_warc(df, path, roll_bytes=500, shards=5).collect()
    assert len(manifest) > 3 and sum(m.records for m in manifest) == len(rows)
    want = []
    for i, _, html in rows:
        data = (html or "").encode()
        top = max((k for k, _, h in rows if h == html and k is not None), default=None)
        copy = i is not None and len(data) >= 1000 and i < top
        want.append((i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if copy else "response", top if copy else None))
    back = warc.read_warc(spark, path).collect()
    assert sorted(map(str, want)) == sorted(str((r.record_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)) for r in back)
    text = {i: h or "" for i, _, h in rows}
    assert all(bytes(r.payload).decode() == text[r.record_id] for r in back if r.record_type == "response")
    uris = {r.record_id: r.url for r in back}
    assert uris[100] == "http://y%20z%0D%0A" and uris[1] is None


def test_same_input_same_bytes(spark):
    df, _ = pages(spark)
    sums = []
    for parts in (3, 7):
        rows = warc.write_warc(df.repartition(parts), scratch_path(spark, "t"), shards=4, roll_bytes=700).collect()
        sums.append(sorted((r.file.rpartition("/")[2], r.sha1, r.records) for r in rows))
    assert sums[0] == sums[1]


def test_shards_are_of_about_equal_size(spark):
    df = spark.range(1000).selectExpr("id AS page_id", "'u' AS url", "repeat(cast(id AS string), 50) AS html")
    rows = warc.write_warc(df, scratch_path(spark, "t"), shards=4).collect()
    assert len(rows) == 4 and max(r.records for r in rows) < 300


def test_files_of_lost_attempts_stay_invisible(spark, tmp_path):
    df, rows = pages(spark)
    path = f"file://{tmp_path}/arc"
    warc.write_warc(df, path, shards=2)
    (tmp_path / "arc" / "_temp-000000-0000-dead").write_bytes(b"half a file")
    assert warc.read_warc(spark, path).count() == len(rows)
    name = next(p for p in (tmp_path / "arc").iterdir() if p.name.startswith("part-"))
    data = bytearray(name.read_bytes())
    data[len(data) // 2] ^= 1
    name.write_bytes(data)
    with pytest.raises(Exception):
        warc.read_warc(spark, path).collect()


def test_empty_table(spark):
    df, _ = pages(spark)
    path = scratch_path(spark, "t")
    assert warc.write_warc(df.limit(0), path).count() == 0
    assert warc.read_warc(spark, path).count() == 0


def test_rows_that_share_an_id_keep_their_own_payloads(spark):
    a, b, c = "a" * 1500, "b" * 1500, "c" * 1500
    rows = [(5, "u1", a), (5, "u2", b), (5, "u3", c), (9, "u4", a), (12, "u5", c), (None, "u6", b), (None, "u7", a)]
    df = spark.createDataFrame([(*r, None, None) for r in rows], SCHEMA)
    path = scratch_path(spark, "t")
    warc.write_warc(df, path, shards=3)
    records = warc.read_warc(spark, path)
    got = sorted(((r.record_id, r.url, r.record_type, r.refers_to, r.payload_digest) for r in records.collect()), key=str)
    refers = {("u1"): 9, ("u3"): 12}
    want = sorted(((i, u, "revisit" if u in refers else "response", refers.get(u), hashlib.sha1(t.encode()).hexdigest())
                   for i, u, t in rows), key=str)
    assert got == want
    payload = {(r.record_id, r.payload_digest): bytes(r.payload).decode() for r in records.collect() if r.payload}
    assert [payload[r[3] if r[3] else r[0], r[4]] for r in got] == [
        dict((u, t) for _, u, t in rows)[r[1]] for r in got]
    assert warc.dangling_revisits(records).count() == 0
    assert warc.dangling_revisits(records.filter("record_id <> 12")).count() == 1


def test_rows_without_id_are_dealt_over_all_shards(spark):
    df = spark.range(600).selectExpr("CAST(NULL AS long) AS page_id", "'u' AS url", "repeat(cast(id AS string), 50) AS html")
    rows = warc.write_warc(df, scratch_path(spark, "t"), shards=4).collect()
    assert len(rows) == 4 and max(r.records for r in rows) < 220
