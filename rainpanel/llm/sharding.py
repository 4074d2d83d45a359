"""Contiguous shards of nearly equal bytes, by prefix sums over per-partition totals."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rainpanel.llm.common import settled

SHARD_FIELDS = ("shard", "slot")


def byte_size(text: Column, per_row: int = 16) -> Column:
    """UTF-8 bytes of a text (none for NULL) and a fixed cost for each row."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + F.lit(per_row)


def assign_shards(rows: DataFrame, size: str, order: Sequence[str], n_shards: int) -> DataFrame:
    """``rows`` with ``shard`` (int, 0 to ``n_shards`` - 1) and ``slot`` (long, gapless from 0 in a shard).

    ``rows`` should be slim: keys and a size, not texts. They are put into one global order, their
    sizes summed by partition, and the running total is cut at equal targets: a row belongs to the
    shard that holds the middle of its bytes. So shards are contiguous in the order, and none
    differs from the target by more than its two outermost rows.

    The only things that meet in one task are one total for each partition and one for each shard.
    Ties in the order, however many, are spread by a random salt before the range exchange; the
    outcome is then written to the checkpoint folder, so a lost executor cannot change it.

    NULL sizes count as 0, negative ones too; NULL keys come first; repeated rows each get a slot;
    an empty table gives an empty result; sizes that are all 0 go to shard 0. Columns of ``rows``
    named ``shard`` or ``slot`` are replaced, others are kept.
    """
    kept = [c for c in rows.columns if c.lower() not in SHARD_FIELDS]
    slim = settled(rows.select(
        *(F.col(f"`{c}`") for c in kept),
        F.greatest(F.coalesce(F.col(f"`{size}`").cast("long"), F.lit(0)), F.lit(0)).alias("__size"),
    ))
    keys = [F.col(f"`{c}`") for c in order]
    ranged = settled(
        slim.withColumn("__salt", F.rand(7)).repartitionByRange(*keys, F.col("__salt"))
        .sortWithinPartitions(*keys, F.col("__salt")).drop("__salt").withColumn("__part", F.spark_partition_id())
    )
    earlier = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # One row for each partition, so its size is bounded by the number of tasks.
    offsets = (
        ranged.groupBy("__part").agg(F.sum("__size").alias("__bytes"), F.count(F.lit(1)).alias("__rows"))
        .select(
            "__part",
            F.coalesce(F.sum("__bytes").over(earlier), F.lit(0)).alias("__bytes_before"),
            F.coalesce(F.sum("__rows").over(earlier), F.lit(0)).alias("__rows_before"),
            F.sum("__bytes").over(everything).alias("__total"),
        )
    )
    schema = T.StructType([
        *ranged.schema, T.StructField("__in_part", T.LongType()), T.StructField("__rank", T.LongType())])
    middle = "cast(2 * (__bytes_before + __in_part) + __size as decimal(20, 0))"
    placed = (
        ranged.mapInArrow(_running_totals, schema).join(F.broadcast(offsets), "__part")
        .withColumn("__place", F.col("__rows_before") + F.col("__rank"))
        .withColumn("shard", F.expr(
            f"cast(least({n_shards - 1}, ({middle} * {n_shards}) div (2 * greatest(__total, 1))) as int)"))
    )
    starts = placed.groupBy("shard").agg(F.min("__place").alias("__first"))  # a row for each shard
    return placed.join(F.broadcast(starts), "shard").select(
        *(F.col(f"`{c}`") for c in kept), "shard", (F.col("__place") - F.col("__first")).alias("slot"))


def _running_totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the bytes and the rows before each row of a partition."""
    total = rank = 0
    for batch in batches:
        sizes = batch.column(batch.schema.get_field_index("__size")).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes, dtype=np.int64) + total
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(ends - sizes), pa.array(np.arange(rank, rank + len(sizes), dtype=np.int64))],
            names=[*batch.schema.names, "__in_part", "__rank"])
        rank += len(sizes)
        total = int(ends[-1]) if len(ends) else total


def write_shards(rows: DataFrame, assigned: DataFrame, key: str, folder: str) -> None:
    """Write the full rows as one folder for each shard, in slot order within a file."""
    (rows.join(assigned.select(key, *SHARD_FIELDS), key).repartition("shard", (F.col("slot") / 100_000).cast("long"))
     .sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(folder))


def shards_query(documents: DataFrame, n_shards: int = 40) -> DataFrame:
    slim = documents.select(
        "doc_id", byte_size(F.col("text")).alias("size"), F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"))
    return assign_shards(slim, "size", ("doc_id", "text_crc32"), n_shards).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
