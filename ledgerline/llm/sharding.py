"""Sharding by extendible hashing: only buckets over the byte limit split, by one more bit of the hash.

The hash is the first 60 bits of the MD5 of the key. Bytes are summed per hash
prefix first, with map-side sums; the directory is grown on those sums, never on
the rows. A bucket ends, and is a shard, when its bytes are within the limit, when
it holds one row, or when all its hashes are equal; its parent is none of these.
Prefixes that must split beyond the bits of a round are summed again, alone, by
further bits.

Buckets of equal hashes over the limit, such as those of one hot key, are split
in the same way by a hash of the row number. So every shard is within the limit
but those that are a single row beyond it.

Null texts have 0 bytes; null keys hash as the empty string. Repeated rows are
sharded each, an empty table has no shard. Other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import materialize

LIMIT = 1 << 20
HASH_BITS = 60
ROUND_BITS = 8  # beyond the depth at which shards of the limit's size are expected


def _hash(value: Column) -> Column:
    return F.conv(F.substring(F.md5(value), 1, HASH_BITS // 4), 16, 10).cast("bigint")


def hashed(documents: DataFrame, key: str = "doc_id") -> DataFrame:
    """``doc_id``, ``bytes``, ``row``, and the hashes of key and row number, as a table."""
    rows = documents.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.octet_length(F.col("text").cast("string")), F.lit(0)).cast("bigint").alias("bytes"),
        _hash(F.coalesce(F.col(key).cast("string"), F.lit(""))).alias("hash"),
        F.monotonically_increasing_id().alias("row"),
    )
    return materialize(rows.withColumn("row_hash", _hash(F.col("row").cast("string"))), "shard-rows")


def _at(depth: Column) -> Column:
    """The first ``depth`` bits of ``hash``."""
    return F.call_function("shiftright", F.col("hash"), F.lit(HASH_BITS) - depth)


def directory(rows: DataFrame, limit: int = LIMIT) -> DataFrame:
    """Buckets of ``bucket``, ``hash``, ``bytes``: ``bucket``, ``depth``, ``prefix``, ``shard_bytes``, ``shard_rows``."""
    total = rows.agg(F.sum("bytes")).first()[0] or 0
    top, work, found = 0, rows, []
    while True:
        low = min(HASH_BITS, max(top, math.ceil(math.log2(max(1.0, total / limit)))) + ROUND_BITS)
        sums = [F.sum("bytes"), F.count("*"), F.min("hash"), F.max("hash")]
        names = ["shard_bytes", "shard_rows", "first", "last"]
        cells = work.groupBy("bucket", _at(F.lit(low)).alias("cell")).agg(*(f.alias(n) for f, n in zip(sums, names)))
        cells = materialize(cells, "shard-cells")
        prefix = F.call_function("shiftright", F.col("cell"), F.lit(low) - F.col("depth")).alias("prefix")
        tree = cells.withColumn("depth", F.explode(F.sequence(F.lit(top), F.lit(low)))).groupBy("bucket", "depth", prefix).agg(
            F.sum("shard_bytes").alias("shard_bytes"), F.sum("shard_rows").alias("shard_rows"),
            F.min("first").alias("first"), F.max("last").alias("last"),
        )
        ends = (F.col("shard_bytes") <= limit) | (F.col("shard_rows") == 1) | (F.col("first") == F.col("last"))
        tree = materialize(tree.withColumn("ends", ends), "shard-tree")
        split = tree.where("not ends")
        above = split.select("bucket", (F.col("depth") + 1).alias("depth"), F.col("prefix").alias("parent"))
        below = tree.where("ends").withColumn("parent", F.shiftright("prefix", 1))
        columns = ["bucket", "depth", "prefix", "shard_bytes", "shard_rows"]
        found.append(below.join(above, ["bucket", "depth", "parent"], "left_semi").select(columns))
        found.append(tree.where("ends and depth = 0").select(columns))
        left = split.where(F.col("depth") == low)
        if left.isEmpty():
            break
        left = left.select("bucket", F.col("prefix").alias("cell"))
        work = work.withColumn("cell", _at(F.lit(low))).join(left, ["bucket", "cell"], "left_semi").drop("cell")
        top = low
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return materialize(out, "shards")


def _place(rows: DataFrame, found: DataFrame) -> DataFrame:
    """``rows`` with their bucket: the one whose prefix they have at its depth."""
    depths = sorted(row.depth for row in found.select("depth").distinct().collect())  # HASH_BITS + 1 at most
    tried = rows.withColumn("depth", F.explode(F.lit(depths).cast("array<int>")))
    placed = tried.withColumn("prefix", _at(F.col("depth"))).join(found, ["bucket", "depth", "prefix"])
    bits = F.lpad(F.conv(F.col("prefix").cast("string"), 10, 2), F.col("depth"), F.lit("0"))
    name = F.concat("bucket", F.when(F.col("depth") == 0, F.lit("")).otherwise(bits))
    return placed.withColumn("shard", name).drop("prefix", "bucket")


def shard(documents: DataFrame, limit: int = LIMIT, key: str = "doc_id") -> DataFrame:
    """Every row with its shard: ``doc_id``, ``bytes``, ``shard``, ``depth``, ``shard_bytes``, ``shard_rows``.

    ``shard`` are the bits of the key's hash and, where those do not suffice, a
    point and the bits of the row's; ``depth`` is the number of the last kind.
    """
    rows = hashed(documents, key)
    first = rows.withColumn("bucket", F.lit(""))
    placed = materialize(_place(first, directory(first, limit)), "shard-places")
    columns = ["doc_id", "bytes", "shard", "depth", "shard_bytes", "shard_rows"]
    over = (F.col("shard_bytes") > limit) & (F.col("shard_rows") > 1)
    done = placed.where(~over).select(columns)
    rest = placed.where(over)
    if rest.isEmpty():
        return done
    again = rest.select("doc_id", "bytes", "row", F.col("row_hash").alias("hash"), F.concat("shard", F.lit(".")).alias("bucket"))
    return done.unionByName(_place(again, directory(again, limit)).select(columns))
