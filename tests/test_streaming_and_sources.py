import datetime as dt
import os
import tempfile

from pyspark.sql import functions as F

from occuspark.sources import files as FS
from occuspark.streaming import observations as OS

SCHEMA = "seq long, ts timestamp_ntz, gym_id string, active_people int"


def test_stream_merge_is_last_write_wins(spark):
    root = tempfile.mkdtemp(prefix="occuspark-stream-")
    src, dst, ckpt = (os.path.join(root, x) for x in ("src", "dst", "ckpt"))
    t = dt.datetime(2026, 5, 1, 10)
    spark.createDataFrame([(1, t, "g1", 10), (2, t, "g1", 11), (3, t, "g2", 5)], SCHEMA).write.mode("append").parquet(src)
    q = OS.start(spark, src, SCHEMA, dst, ckpt)
    q.awaitTermination()
    spark.createDataFrame([(4, t, "g1", 99)], SCHEMA).write.mode("append").parquet(src)
    q = OS.start(spark, src, SCHEMA, dst, ckpt)
    q.awaitTermination()
    out = {(r.gym_id, r.active_people) for r in spark.read.parquet(dst).collect()}
    assert out == {("g1", 99), ("g2", 5)}
    assert spark.read.parquet(dst).count() == 2


def test_raw_csv_reader_rules(spark):
    root = tempfile.mkdtemp(prefix="occuspark-csv-")
    path = os.path.join(root, "raw.csv")
    with open(path, "w", encoding="utf-8-sig") as fh:
        fh.write("timestamp,city,address,active_people,source_file\n")
        fh.write("2026-05-01 10:00:00,  Kyiv ,A,12.7,f\n2026-05-01 10:20:00,Kyiv,A,bad,f\n2025-05-01 10:40:00,Kyiv,A,-4,f\n")
    rows = FS.read_raw_observations(spark, path, year=2026).orderBy("ts").collect()
    assert [r.active_people for r in rows] == [0, 12, 0]
    assert rows[1].city == "Kyiv" and [r.year_ok for r in rows] == [0, 1, 1]


def test_write_csv_refuses_empty(spark):
    import pytest
    with pytest.raises(ValueError):
        FS.write_csv(spark.range(0), os.path.join(tempfile.mkdtemp(), "x"))


def test_jsonl_corrupt_lines_flagged(spark):
    root = tempfile.mkdtemp(prefix="occuspark-jsonl-")
    path = os.path.join(root, "d.jsonl")
    with open(path, "w") as fh:
        fh.write('{"a": 1}\n{oops\n{"a": 2}\n')
    df = FS.read_jsonl(spark, path, "a bigint")
    rows = df.select("a", "_corrupt").collect()
    assert [r.a for r in rows if r._corrupt is None] == [1, 2] and sum(r._corrupt is not None for r in rows) == 1


def test_stream_merge_refuses_other_columns_and_replays(spark):
    import pytest
    dst = os.path.join(tempfile.mkdtemp(prefix="occuspark-merge-"), "t")
    t = dt.datetime(2026, 5, 1, 10)
    first = spark.createDataFrame([(1, t, "g1", 10), (2, t, "g2", 5)], SCHEMA)
    OS.merge_batch(first, dst)
    before = sorted(tuple(r) for r in spark.read.parquet(dst).select("seq", "gym_id", "active_people").collect())
    with pytest.raises(ValueError):
        OS.merge_batch(spark.createDataFrame([(3, t, "g1")], "seq long, ts timestamp_ntz, gym_id string"), dst)
    OS.merge_batch(first, dst)  # a replayed batch changes nothing
    assert sorted(tuple(r) for r in spark.read.parquet(dst).select("seq", "gym_id", "active_people").collect()) == before


def test_preview_documents_read_back(spark):
    path = os.path.join(tempfile.mkdtemp(), "p.json")
    with open(path, "w") as fh:
        fh.write('{"status": "preview", "source_name": "s",\n "records": [{"slug": "a"}, {"slug": "b"}]}')
    assert [r.slug for r in FS.read_json_preview(spark, path, "slug string").collect()] == ["a", "b"]
