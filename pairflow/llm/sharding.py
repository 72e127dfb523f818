"""Shards of a globally shuffled table: a two-pass external shuffle.

Pass 1 scatters the rows uniformly into buckets by a seeded hash, as many
buckets as it takes for one to fit ``BUCKET`` bytes; each bucket is put into
seeded Fisher-Yates order in memory (Spark's ``shuffle`` of an array) and
written.  Pass 2 numbers the written rows: a row's rank is its place in its
bucket behind all earlier buckets, and ranks are dealt to shards in turn, so
shards' row counts are at most one apart and slots have no gaps (law ``rows``).
``write`` and ``written`` carry whole rows through both passes into shards' files.

A row's bucket comes from its id, its text and the input partition it stands
in, so neither an id nor a text that a third of the rows share fills a bucket.
Buckets are sorted before they are shuffled and have a fixed partition each:
a task that runs again gives the same order.

Defined results: a null text has no bytes; null ids, repeated rows and copies
each get a place of their own; a very long text is one row of its bucket; an
empty table gives no rows; carried columns keep their names unless they are
``shard`` or ``slot``, which are replaced.  Everything is DataFrame functions.
"""

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pairflow.llm.base import saved
from pairflow.session import ensure_checkpoint_dir

SHARDS, SEED = 24, 42
BUCKET = 32 << 20  # bytes of rows in a bucket
ROW = 48  # bytes of a row's fixed part
BLOCK = 1024  # buckets whose sizes are added up together


def _offsets(rows: DataFrame) -> DataFrame:
    """(bucket, before): rows in all earlier buckets; sums within blocks of
    buckets, then over blocks."""
    sizes = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).withColumn("block", F.floor(F.col("bucket") / BLOCK))
    earlier = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    within = F.coalesce(F.sum("size").over(earlier(Window.partitionBy("block").orderBy("bucket"))), F.lit(0))
    blocks = sizes.groupBy("block").agg(F.sum("size").alias("size"))
    over = F.coalesce(F.sum("size").over(earlier(Window.partitionBy(F.lit(0)).orderBy("block"))), F.lit(0))
    blocks = blocks.select("block", over.alias("over"))
    return sizes.select("bucket", "block", within.alias("within")).join(blocks, "block").select("bucket", (F.col("over") + F.col("within")).alias("before"))


def shuffled(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: tuple = (), seed: int = SEED, bucket: int = BUCKET) -> DataFrame:
    """Pass 1, written: (bucket, at, r) with r the struct of id, size, crc and
    the carried columns of a row, ``at`` its place in the shuffled bucket."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    size = F.octet_length(text).cast("long")
    key = F.xxhash64(F.lit(seed), F.col(id_col).cast("string"), text, F.spark_partition_id())
    row = [F.col(id_col).alias("id"), (size + 8).alias("size"), F.crc32(text).alias("crc")]
    if carry:
        row.append(F.struct(*carry).alias("carried"))
    weight = F.lit(ROW) + (size if text_col in carry else F.lit(0))
    total = docs.select(weight.alias("w")).agg(F.sum("w")).first()[0] or 0
    buckets = max(1, -(-total // bucket))
    rows = docs.select(F.pmod(key, F.lit(buckets)).alias("bucket"), key.alias("key"), *row)
    r = [c for c in rows.columns if c not in ("bucket", "key")]
    # Sorted by key, then by what can be compared: equal rows may change places.
    element = F.struct("key", "size", "crc", F.col("id").cast("string").alias("name"), F.struct(*r).alias("r"))
    lists = rows.repartition(buckets, "bucket").groupBy("bucket").agg(F.collect_list(element).alias("rows"))
    by = lambda a, b: F.when(_key(a) < _key(b), -1).when(_key(a) > _key(b), 1).otherwise(0)
    lists = lists.sortWithinPartitions("bucket").select("bucket", F.shuffle(F.array_sort("rows", by), seed).alias("rows"))
    placed = lists.select("bucket", F.posexplode("rows").alias("at", "e"))
    return saved(placed.select("bucket", "at", "e.r"))


def _key(e):
    return F.struct(e["key"], e["size"], e["crc"], e["name"])


def assign(
    docs: DataFrame,
    shards: int = SHARDS,
    id_col: str = "doc_id",
    text_col: str = "text",
    carry: tuple = (),
    seed: int = SEED,
    bucket: int = BUCKET,
) -> DataFrame:
    """(id, size, crc, shard, slot, carried) of every row."""
    rows = shuffled(docs, id_col, text_col, carry, seed, bucket)
    rank = F.col("before") + F.col("at")
    # A row for each bucket: sent to the tasks, so that the rows stay where they were written.
    placed = rows.join(F.broadcast(_offsets(rows)), "bucket").select("r.*", (rank % shards).cast("int").alias("shard"), F.floor(rank / shards).alias("slot"))
    return placed


def _whole(docs: DataFrame, shards: int, id_col: str, text_col: str, seed: int) -> DataFrame:
    """(shard, slot, all columns of ``docs``)."""
    carry = tuple(c for c in docs.columns if c.lower() not in ("shard", "slot"))
    return assign(docs, shards, id_col, text_col, carry, seed).select("shard", "slot", "carried.*")


def write(docs: DataFrame, path: str, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED) -> None:
    """Write all columns of ``docs`` as Parquet folders ``shard=0`` and so on, each in
    the order of ``slot``; many tasks share a shard, ranges of slots each."""
    rows = _whole(docs, shards, id_col, text_col, seed)
    rows.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def written(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED) -> DataFrame:
    """The rows of the shards' files, written into the session's shared folder:
    all columns of ``docs``, with slot and shard.  As a bucket's ranks follow one
    another, pass 2 moves no row: a task writes its buckets' part of every shard,
    each file in the order of ``slot``."""
    folder = ensure_checkpoint_dir(docs.sparkSession)
    if not folder:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    path = f"{folder}/shards-{uuid.uuid4().hex}"
    rows = _whole(docs, shards, id_col, text_col, seed)
    rows.sortWithinPartitions("shard", "slot").write.partitionBy("shard").option("compression", "zstd").parquet(path)
    fields = [f for f in rows.schema.fields if f.name != "shard"] + [rows.schema["shard"]]
    return docs.sparkSession.read.schema(type(rows.schema)(fields)).parquet(path)
