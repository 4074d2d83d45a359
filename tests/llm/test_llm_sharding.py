import zlib

import pytest
from llm_cases import clashing, documents
from pyspark.sql import functions as F

from rainpanel.llm import sharding


def test_shards_are_contiguous_even_and_gapless(spark):
    got = sharding.shards_query(clashing(documents(spark)), 5).collect()
    source = documents(spark).collect()
    want = sorted((len((r.text or "").encode()) + 16, zlib.crc32((r.text or "").encode()), str(r.doc_id)) for r in source)
    assert sorted((r["size"], r.text_crc32, str(r.doc_id)) for r in got) == want
    total, largest = sum(r["size"] for r in got), max(r["size"] for r in got)
    for shard in range(5):
        mine = [r for r in got if r.shard == shard]
        assert sorted(r.slot for r in mine) == list(range(len(mine)))
        assert abs(sum(r["size"] for r in mine) - total / 5) <= largest
    ordered = sorted((r.shard, r.slot, -1 if r.doc_id is None else r.doc_id) for r in got)
    assert [x[2] for x in ordered] == sorted(x[2] for x in ordered)
    assert all(r.law == "bytes" and r.grown_shard is None for r in got)


def test_many_ties_and_equal_sizes(spark):
    frame = spark.range(10_000).select(F.lit(7).cast("long").alias("doc_id"), F.lit("same").alias("text")).repartition(4)
    counts = sharding.shards_query(frame, 8).groupBy("shard").agg(F.count("*"), F.max("slot")).collect()
    assert len(counts) == 8 and all(abs(n - 1250) <= 1 and top == n - 1 for _, n, top in counts)


def test_same_result_for_any_layout(spark):
    frame = spark.range(3_000).select("id", (F.col("id") % 97).alias("size"))
    a = sharding.assign_shards(frame.repartition(2), "size", ["id"], 6)
    b = sharding.assign_shards(frame.repartition(9), "size", ["id"], 6)
    assert a.exceptAll(b).isEmpty() and a.columns == ["id", "size", "shard", "slot"]


@pytest.mark.parametrize("rows", [[], [(1, 0), (2, 0)], [(1, None), (2, 5)], [(1, -4)]])
def test_odd_sizes(spark, rows):
    got = sharding.assign_shards(spark.createDataFrame(rows, "id long, size long"), "size", ["id"], 3).collect()
    assert len(got) == len(rows) and all(0 <= r.shard < 3 for r in got)


def test_written_shards_hold_every_row(spark, tmp_path):
    frame = spark.range(500).select("id", F.lit("text").alias("text"))
    placed = sharding.assign_shards(frame.select("id", F.lit(20).alias("size")), "size", ["id"], 4)
    sharding.write_shards(frame, placed, "id", str(tmp_path / "shards"))
    assert spark.read.parquet(str(tmp_path / "shards")).groupBy("shard").count().collect().__len__() == 4
