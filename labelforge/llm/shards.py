"""Operator 7: global random order by a two-pass external shuffle.

Pass 1 scatters all records by a seeded hash into buckets that fit into a task's memory.
Pass 2 shuffles each bucket by Fisher-Yates with the bucket's own seed and writes it.
The buckets in a row are a uniform random order; shards are equal stretches of it, so
their row counts differ by at most one and no shard has to be filled by one task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelforge.llm.common import read, release_memory, written
from labelforge.operators.sizing import sized_join

SHARDS, SEED, BUCKET_BYTES = 24, 20_240_607, 4 << 20


def _fisher_yates(n: int, seed: int, bucket: int) -> np.ndarray:
    """A uniform random order of 0 .. n - 1."""
    order = np.arange(n)
    pick = np.random.Generator(np.random.PCG64([seed, bucket])).random(n)
    for k in range(n - 1, 0, -1):
        j = int(pick[k] * (k + 1))
        order[k], order[j] = order[j], order[k]
    return order


def shuffled_buckets(docs: DataFrame, seed: int = SEED,
                     bucket_bytes: int = BUCKET_BYTES) -> tuple[DataFrame, int]:
    """``docs(text, ...)`` in written buckets, with ``_bucket`` and the ``_place`` in it, and the
    number of buckets.

    The bucket hashes the row's position in the input along with its text, so repeated
    rows scatter like any others; the same input files give the same order."""
    size = docs.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 64).alias("n")).first()["n"] or 0
    buckets = max(1, -(-size // bucket_bytes))
    position = F.monotonically_increasing_id()
    keyed = docs.select("*", position.alias("_position")) \
        .withColumn("_bucket", F.pmod(F.xxhash64(F.lit(seed), "_position", F.crc32(F.col("text").cast("binary"))),
                                      F.lit(buckets)))
    schema = T.StructType([*docs.schema.fields, T.StructField("_bucket", T.LongType()),
                           T.StructField("_place", T.LongType())])
    columns = docs.columns

    def shuffle(table):
        bucket, n = table.column("_bucket")[0].as_py(), table.num_rows
        # by position first: the order in which a shuffle delivers rows must not matter
        at = pc.sort_indices(table.column("_position")).to_numpy()
        order = pa.array(at[_fisher_yates(n, seed, bucket)])
        out = table.select([*columns, "_bucket"]).take(order)
        release_memory()
        return out.append_column("_place", pa.array(np.arange(n)))

    return written(keyed.groupBy("_bucket").applyInArrow(shuffle, schema), "buckets"), buckets


def shard(docs: DataFrame, shards: int = SHARDS, seed: int = SEED,
          bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """``docs`` with ``shard`` (0 .. shards - 1) and ``slot`` (gapless from 0 in its shard).

    Row counts of the shards differ by at most one.  Null and empty texts, null ids, repeated
    rows and texts larger than a bucket are rows like any other; an empty table gives an
    empty result.  The bucket counts, one row per bucket,
    are summed to offsets; no other row passes through one task.  Columns of ``docs`` named
    shard or slot are replaced, names with a leading underscore are reserved."""
    docs = docs.drop("shard", "slot")
    placed, buckets = shuffled_buckets(docs, seed, bucket_bytes)
    counts = placed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
    running = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    offsets = counts.select(F.col("_bucket").alias("_b"), F.coalesce(F.sum("_n").over(running), F.lit(0)).alias("_before"),
                            F.sum("_n").over(whole).alias("_total"))
    place = F.col("_before") + F.col("_place")
    base, extra = F.floor(F.col("_total") / shards), F.col("_total") % shards
    # the first `extra` shards hold base + 1 rows, the others base
    long_rows = extra * (base + 1)
    at = F.when(place < long_rows, F.floor(place / (base + 1))) \
        .otherwise(extra + F.floor((place - long_rows) / F.greatest(base, F.lit(1))))
    first = F.when(F.col("shard") < extra, F.col("shard") * (base + 1)) \
        .otherwise(long_rows + (F.col("shard") - extra) * base)
    # as many rows as buckets: the records themselves stay where they are
    met = sized_join(placed, offsets, lambda a, b: a["_bucket"] == b["_b"], "inner", ["_bucket", "_place"],
                     known_bytes=64 * buckets)
    joined = met.withColumn("_at", place).withColumn("shard", at.cast("int"))
    return joined.withColumn("slot", (F.col("_at") - first).cast("long")).select(*docs.columns, "shard", "slot")


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder per shard, rows in slot order."""
    sharded.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot") \
        .write.partitionBy("shard").parquet(path)


def query(spark, sf_dir: str) -> DataFrame:
    """op7: the shard and slot of every document."""
    out = shard(read(spark, sf_dir, "documents", "doc_id", "text"))
    return out.select("doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("long").alias("size"),
                      F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
                      F.lit("rows").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))
