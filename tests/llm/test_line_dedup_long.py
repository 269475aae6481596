"""Line dedup of long texts, hot texts and hot lines."""

import time

from pyspark.sql import functions as F

from martlet.llm import line_dedup


def test_text_of_many_dropped_lines(spark):
    lines = [f"shared line {i}" for i in range(100_000)]
    short = spark.range(9).selectExpr("id as doc_id").withColumn("text", F.lit("\n".join(lines)))
    long_ = spark.createDataFrame([(9, "own first\n" + "\n".join(f" {x.upper()} " for x in lines) + "\nown last")], "doc_id long, text string")
    df = short.union(long_).repartition(4).cache()
    df.count()
    started = time.time()
    out = {r.doc_id: r.line_dedup for r in line_dedup.dedup_lines(df).collect()}
    assert time.time() - started < 60  # of it, the rebuild of each text takes well below a second
    assert out[9].kept == "own first\nown last" and out[9].n_lines == 100_002 and out[9].n_dropped == 100_000
    assert all(out[i].kept == "" and out[i].n_dropped == 100_000 for i in range(9))


def test_hot_text_and_hot_line_are_dealt(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "PROBES_PER_GROUP", 8)  # many copies of each hot shard
    df = spark.range(300).selectExpr("id as doc_id", """case when id % 3 = 0 then 'one text\\nin many copies'
        when id % 3 = 1 then concat('Common line\\nown ', id) else concat('own ', id, '\\n\\n é ', id) end as text""").repartition(5)
    out = {r.doc_id: r.line_dedup for r in line_dedup.dedup_lines(df).collect()}
    assert all(out[i].kept == "" and out[i].n_dropped == 2 for i in range(0, 300, 3))
    assert all(out[i].kept == f"own {i}" and out[i].n_dropped == 1 for i in range(1, 300, 3))
    assert all(out[i].kept == f"own {i}\n\n é {i}" and out[i].n_dropped == 0 and out[i].n_lines == 3 for i in range(2, 300, 3))


def test_short_keys_stay(spark):
    df = spark.range(20).selectExpr("id as doc_id", "concat('é\\nabc\\nabcd\\n', id) as text")
    kept = {r.line_dedup.kept for r in line_dedup.dedup_lines(df, min_chars=4).collect()}
    assert kept == {f"é\nabc\n{i}" for i in range(20)}
