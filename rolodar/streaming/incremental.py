"""Incremental unification: new records of a stream are resolved against what their blocks hold.

Our own extension: every micro-batch is appended to the store of raw records, each with its block key, partitioned by
batch and by a bucket of that key. A batch so reads only the buckets of the blocks it touches, and only the records of
these blocks are normalised and resolved again. Blocks are closed under matching, so the untouched rest stays valid.

Defined results: a repeated batch overwrites itself; a ``rec_idx`` that stands in another batch of a touched block is an
error; empty batches touch nothing and hand on nothing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rolodar import config as cfg
from rolodar.operators import resolve
from rolodar.operators.normalize import normalize
from rolodar.plans.pipeline import Result, unify
from rolodar.runtime import cut

BUCKETS = 256


def keyed(batch: DataFrame, config: cfg.Config = cfg.Config()) -> DataFrame:
    """The batch with ``block_key`` and the ``bucket`` it is stored in."""
    keys = resolve.with_keys(normalize(batch, config.normalization)).select("rec_idx", "block_key")
    return batch.join(keys, "rec_idx").withColumn("bucket", F.pmod(F.xxhash64("block_key"), F.lit(BUCKETS)).cast("int"))


def append(batch: DataFrame, batch_id: int, store_path: str, config: cfg.Config = cfg.Config()) -> DataFrame:
    """Writes the batch into the store; returns its distinct blocks (block_key, bucket)."""
    rows = cut(keyed(batch, config))
    # One file per bucket and batch.
    rows.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{store_path}/batch={batch_id}")
    return rows.select("block_key", "bucket").distinct()


def touched(store: DataFrame, blocks: DataFrame) -> DataFrame:
    """Records of ``store`` in ``blocks``; only the files of their buckets (at most ``BUCKETS`` numbers) are opened."""
    buckets = [r["bucket"] for r in blocks.select("bucket").distinct().collect()]
    return store.where(F.col("bucket").isin(buckets)).join(blocks.select("block_key"), "block_key", "left_semi")


def start(stream: DataFrame, store_path: str, checkpoint: str, sink: Callable[[Result, int], None], config: cfg.Config = cfg.Config()) -> StreamingQuery:
    """Appends each micro-batch of contact records to ``store_path`` and hands the re-resolved blocks to
    ``sink(result, batch id)``."""

    def step(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        blocks = cut(append(batch, batch_id, store_path, config))
        if blocks.isEmpty():
            return
        mine = cut(touched(spark.read.parquet(store_path), blocks).drop("batch", "bucket", "block_key"))
        twice = mine.groupBy("rec_idx").agg(F.count("*").alias("n")).where("n > 1").limit(1).collect()
        if twice:
            raise ValueError(f"rec_idx {twice[0]['rec_idx']} stands in more than one batch")
        sink(unify(mine, config), batch_id)

    return stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).start()
