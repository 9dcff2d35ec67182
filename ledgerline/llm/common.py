"""Helpers shared by the text operators: scratch tables, words of Arrow columns, components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.session import shared_folder
from ledgerline.sinks import files

# Text handled at once inside a task, in bytes; a longer text is handled alone.
# Spark itself cuts the batches that a task gets at 64 MB.
SLICE_BYTES = 8 << 20


def materialize(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = shared_folder(spark, purpose)
    df.write.option("compression", "zstd").parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table._scratch_path = path
    return table


def release(*tables: DataFrame) -> None:
    """Removes tables made by ``materialize`` that nothing reads any more; other frames are left alone."""
    for table in tables:
        if path := getattr(table, "_scratch_path", None):
            files.remove(table.sparkSession, path)


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Row ranges of ``batch`` whose ``column`` holds at most ``limit`` bytes, one row at least."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes.astype(np.int64))
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop
    pa.default_memory_pool().release_unused()


def byte_map(texts: pa.Array, table: np.ndarray) -> pa.Array:
    """``texts`` with every byte replaced by ``table[byte]``; nulls become empty texts."""
    texts = pc.fill_null(texts, "")
    _, offsets, data = texts.buffers()
    if data is None or not data.size:
        return texts
    # A slice shares the buffers of its batch: only its own bytes are mapped.
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    ends = np.frombuffer(offsets, kind)[texts.offset : texts.offset + len(texts) + 1]
    mapped = table[np.frombuffer(data, np.uint8)[ends[0] : ends[-1]]] if len(ends) else np.zeros(0, np.uint8)
    own = pa.py_buffer(ends - ends[0] if len(ends) else np.zeros(1, kind))
    return pa.Array.from_buffers(texts.type, len(texts), [None, own, pa.py_buffer(mapped)])


def _table(separators: np.ndarray, lower: bool) -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    if lower:
        table[ord("A") : ord("Z") + 1] += 32
    table[separators] = 32
    return table


# Byte tables: A-Z in lower case and everything but digits, letters and non-ASCII
# as blanks; A-Z in lower case; unchanged. The last two leave white space as it is.
_ASCII = np.arange(128, dtype=np.uint8)
_WORD_BYTES = np.frombuffer(b"0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ", np.uint8)
ALNUM_LOWER = _table(np.setdiff1d(_ASCII, _WORD_BYTES), lower=True)
SPACE_LOWER = _table(np.array([], dtype=np.uint8), lower=True)
SPACE_ONLY = _table(np.array([], dtype=np.uint8), lower=False)


def words(texts: pa.Array, table: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """All words of ``texts`` in one flat array, and the index of each text's first word.

    A word is a run without the bytes 9-13 and 32 after ``table`` was applied. The
    second result has one more entry, the number of words.
    """
    split = pc.ascii_split_whitespace(byte_map(texts, table))
    flat = split.flatten()
    ends = np.concatenate(([0], np.cumsum(pc.list_value_length(split).to_numpy(zero_copy_only=False))))
    full = pc.binary_length(flat).to_numpy(zero_copy_only=False) > 0
    if not full.all():
        kept = np.concatenate(([0], np.cumsum(full)))
        flat, ends = flat.filter(pa.array(full)), kept[ends.astype(np.int64)]
    return flat, ends.astype(np.int64)


def codes(flat: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """``flat`` as indices into its distinct values, and those values."""
    encoded = flat.dictionary_encode()
    if isinstance(encoded, pa.ChunkedArray):
        encoded = encoded.combine_chunks()
    return encoded.indices.to_numpy(zero_copy_only=False), encoded.dictionary


# Ids that are broadcast for a join, some 64 MB at most in an executor.
BROADCAST_IDS = 1_000_000


# Bytes of a joined table's rows up to which it is broadcast; the driver holds them some four times over.
BROADCAST_BYTES = 8 << 20


def dealt(rows: DataFrame, row_bytes: Column) -> DataFrame:
    """``rows``, read from a written table, for a join: broadcast while they are small as rows, and shuffled beyond.

    Spark would take their size from their files, which hold texts that repeat from
    row to row packed to a hundredth, and would send all of them through the driver.
    """
    size = rows.agg(F.sum(row_bytes.cast("bigint"))).first()[0] or 0
    return F.broadcast(rows) if size <= BROADCAST_BYTES else rows.hint("merge")


def without(rows: DataFrame, ids: DataFrame, match: Column | None = None) -> DataFrame:
    """``rows`` that match none of ``ids``, a written table of its own; they match by ``doc_id``, nulls too.

    As long as the ids are few they are broadcast and the rows stay where they
    are; beyond ``BROADCAST_IDS`` Spark decides, and may shuffle both.
    """
    few = ids.count() <= BROADCAST_IDS
    match = rows["doc_id"].eqNullSafe(ids["doc_id"]) if match is None else match
    return rows.join(F.broadcast(ids) if few else ids, match, "left_anti")


# Ids that a filter takes; its bits are 16 for each, 16 MB at most.
FILTER_IDS = 8_000_000


class IdFilter:
    """A Bloom filter of ids with two hashes: tells for certain that an id was not put in."""

    def __init__(self, n_bits: int):
        self.words = np.zeros(n_bits // 64, np.uint64)
        self.last = np.uint64(n_bits - 1)

    def places(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Word and bit of each id, for both hashes one after the other."""
        x = np.concatenate([ids.view(np.uint64) + np.uint64(salt) for salt in (0x9E3779B97F4A7C15, 0x3C6EF372FE94F82B)])
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        at = (x ^ (x >> np.uint64(31))) & self.last
        return (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63))

    def may_hold(self, ids: np.ndarray) -> np.ndarray:
        word, bit = self.places(ids)
        found = (self.words[word] & bit) != 0
        return found[: len(ids)] & found[len(ids) :]


def id_filter(ids: DataFrame) -> Broadcast | None:
    """A broadcast ``IdFilter`` of the only column, without nulls; None when there are more than ``FILTER_IDS``."""
    n = ids.count()
    if n > FILTER_IDS:
        return None
    made = IdFilter(1 << max(10, (16 * n - 1).bit_length()))

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            word, bit = made.places(batch.column(0).to_numpy(zero_copy_only=False))
            yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(bit.view(np.int64))], ["word", "bits"])

    rows = ids.mapInArrow(put, "word bigint, bits bigint").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    made.words[rows.column("word").to_numpy()] = rows.column("bits").to_numpy().view(np.uint64)
    return ids.sparkSession.sparkContext.broadcast(made)


def components(edges: DataFrame, purpose: str) -> DataFrame:
    """Connected components of the links ``a``, ``b`` (bigint): ``node`` and ``component``, its smallest node.

    Large-star and small-star steps in turns until no link changes. Every step
    groups by a node with map-side minima and writes its links to the shared
    folder; a hub's neighbours are joined with its minimum, never collected.
    """
    links = materialize(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), purpose
    )
    before = None
    while True:
        both = links.unionAll(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        least = materialize(least, purpose)  # joined as a table of its own, a hub's links can be split
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = materialize(large.where("u <> v").distinct(), purpose)
        release(links, least)
        least = materialize(large.groupBy("u").agg(F.min("v").alias("m")), purpose)
        moved = large.join(least, "u")
        small = moved.select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(
            least.select("u", F.col("m").alias("v"))
        )
        links = materialize(small.where("u <> v").distinct(), purpose)
        release(large, least)
        now = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before or not now[0]:
            break
        before = now
    pairs = links.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    found = pairs.unionAll(roots)
    found._scratch_path = links._scratch_path
    return found
