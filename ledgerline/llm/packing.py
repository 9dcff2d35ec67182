"""Best-fit packing of tokenised documents into sequences, after dominance reduction.

Only piece lengths matter, and there are at most ``capacity`` of them, so the
instance is a histogram of bounded size however many documents there are. On it
two steps run, both for all pieces of a length at once:

1. Martello-Toth dominance, from the longest piece on. A set that holds the piece
   and dominates every other feasible set with it is fixed for good: the piece
   alone if nothing fits beside it; with the largest partner if that fills the
   sequence, if no two pieces fit beside it, or if no three do and no two together
   exceed the partner. Repeated on the smaller instance until nothing is fixed.
2. Best fit, longest first, on the remainder: a piece goes where it leaves least.

The result is a list of patterns with counts, which are dealt to the pieces by
their rank among those of equal length. Ranks are taken in hash buckets, so that
a length shared by most pieces is spread over many tasks.

Null and empty texts are one piece of the end token. Repeated rows are packed each
by itself; a null ``doc_id`` is kept. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import materialize, slices
from ledgerline.llm.tokens import word_encoder

CAPACITY = 4096
END = 1
ROWS_PER_BUCKET = 1_000_000
PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"

# (length, copies) of one sequence, longest first
Pattern = tuple[tuple[int, int], ...]


def pieces(documents: DataFrame, tokenizer: str, capacity: int = CAPACITY, end: int = END, with_ids: bool = False) -> DataFrame:
    """The documents' ids, with ``end`` behind, cut every ``capacity`` ids; ``with_ids`` adds them as ``ids``."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(tokenizer)
        for batch in batches:
            for part in slices(batch, "text"):
                flat, firsts = encoder.ids(pc.fill_null(part.column("text"), ""))
                rows: list[tuple] = []
                ids: list[np.ndarray] = []
                for doc, a, b in zip(part.column("doc_id").to_pylist(), firsts[:-1], firsts[1:]):
                    whole = np.append(flat[a:b], np.array(end, "<u4"))
                    for piece, start in enumerate(range(0, len(whole), capacity)):
                        own = whole[start : start + capacity]
                        rows.append((doc, piece, start, len(own), zlib.crc32(own.tobytes())))
                        if with_ids:
                            ids.append(own)
                doc, piece, start, length, crc = zip(*rows)
                columns = [
                    pa.array(doc, pa.int64()), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()), pa.array(crc, pa.int64()),
                ]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    ends = np.concatenate(([0], np.cumsum(length))).astype(np.int32)
                    columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids).view(np.int32))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)

    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(cut, PIECES + (", ids array<int>" if with_ids else ""))


def _smallest(counts: dict[int, int], sizes: list[int], n: int, but: int) -> list[int]:
    """The ``n`` smallest pieces left, with repeats, one copy of ``but`` set aside."""
    out: list[int] = []
    for size in sizes:
        left = counts[size] - (size == but)
        out += [size] * min(left, n - len(out))
        if len(out) == n:
            break
    return out


def _best_pair(counts: dict[int, int], sizes: list[int], room: int, but: int) -> int:
    """Largest sum of two pieces that is at most ``room``, one copy of ``but`` set aside; 0 if there is none."""
    left = [s for s in sizes if s < room and counts[s] - (s == but) > 0]
    best, i, j = 0, 0, len(left) - 1
    while i <= j:
        if i == j and counts[left[i]] - (left[i] == but) < 2:
            break
        if left[i] + left[j] > room:
            j -= 1
        else:
            best = max(best, left[i] + left[j])
            i += 1
    return best


def reduce_by_dominance(counts: dict[int, int], capacity: int) -> tuple[list[tuple[Pattern, int]], dict[int, int]]:
    """Patterns fixed by dominance, and the smaller instance that remains."""
    counts = {size: n for size, n in counts.items() if n}
    fixed: list[tuple[Pattern, int]] = []
    sizes = sorted(counts)

    def take(size: int, n: int) -> None:
        counts[size] -= n
        if not counts[size]:
            del counts[size], sizes[bisect_left(sizes, size)]

    changed = True
    while changed:
        changed = False
        for big in sizes[::-1]:
            while counts.get(big):
                room = capacity - big
                small = _smallest(counts, sizes, 3, big)
                if not small or small[0] > room:
                    fixed.append((((big, 1),), counts[big]))
                    take(big, counts[big])
                    changed = True
                    break
                at = bisect_left(sizes, room + 1) - 1
                partner = sizes[at]
                if partner == big and counts[big] < 2:
                    partner = sizes[at - 1]
                alone = len(small) < 2 or small[0] + small[1] > room
                no_three = len(small) < 3 or sum(small) > room
                if not (
                    partner == room
                    or alone
                    or (no_three and _best_pair(counts, sizes, room, big) <= partner)
                ):
                    break
                n = counts[big] // 2 if partner == big else min(counts[big], counts[partner])
                fixed.append((((big, 2),) if partner == big else ((big, 1), (partner, 1)), n))
                take(big, 2 * n if partner == big else n)
                if partner != big:
                    take(partner, n)
                changed = True
    return fixed, counts


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[Pattern, int]]:
    """Patterns of best fit, longest pieces first. Sequences with equal contents are handled together."""
    open_: dict[int, list[tuple[Pattern, int]]] = {}
    rooms: list[int] = []
    closed: list[tuple[Pattern, int]] = []

    def put(pattern: Pattern, n: int) -> None:
        room = capacity - sum(size * copies for size, copies in pattern)
        if not room:
            closed.append((pattern, n))
            return
        if room not in open_:
            open_[room] = []
            insort(rooms, room)
        open_[room].append((pattern, n))

    for size in sorted(counts, reverse=True):
        left = counts[size]
        while left:
            at = bisect_left(rooms, size)
            if at == len(rooms):
                each = capacity // size
                if left >= each:
                    put(((size, each),), left // each)
                if left % each:
                    put(((size, left % each),), 1)
                break
            room = rooms[at]
            pattern, n = open_[room].pop()
            if not open_[room]:
                del open_[room], rooms[at]
            each = room // size
            full = min(n, left // each)
            if full:
                put((*pattern, (size, each)), full)
            left -= full * each
            n -= full
            if n and left:
                put((*pattern, (size, left)), 1)
                left, n = 0, n - 1
            if n:
                put(pattern, n)
    return closed + [group for groups in open_.values() for group in groups]


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[Pattern, int]]:
    """Patterns and how many sequences have each, for ``counts`` pieces of each length."""
    fixed, rest = reduce_by_dominance(counts, capacity)
    return fixed + best_fit(rest, capacity)


def _slots(patterns: list[tuple[Pattern, int]]) -> dict[int, np.ndarray]:
    """For each length its slots, a row each: first rank, first sequence, copies in a sequence, offset of the first."""
    out: dict[int, list[tuple[int, int, int, int]]] = {}
    ranks: dict[int, int] = {}
    sequence = 0
    for pattern, n in patterns:
        offset = 0
        for size, copies in pattern:
            first = ranks.get(size, 0)
            out.setdefault(size, []).append((first, sequence, copies, offset))
            ranks[size] = first + n * copies
            offset += size * copies
        sequence += n
    return {size: np.array(rows, np.int64) for size, rows in out.items()}


def pack(documents: DataFrame, tokenizer: str, capacity: int = CAPACITY, end: int = END, with_ids: bool = False) -> DataFrame:
    """Pieces with ``sequence_id`` and ``offset``: their place in a sequence of at most ``capacity`` ids."""
    spark = documents.sparkSession
    cut = materialize(pieces(documents, tokenizer, capacity, end, with_ids), "pieces")
    counts = {row.length: row.n for row in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    names = cut.columns
    slots = spark.sparkContext.broadcast(_slots(plan(counts, capacity)))
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-sum(counts.values()) // ROWS_PER_BUCKET))
    rows = cut.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(buckets)))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    firsts = (
        rows.groupBy("length", "bucket").agg(F.count("*").alias("n"))
        .select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    )
    own = Window.partitionBy("bucket", "length").orderBy("doc_id", "piece")
    ranked = (
        rows.withColumn("own", F.row_number().over(own) - 1)
        .join(firsts, ["bucket", "length"])
        .withColumn("rank", F.col("first") + F.col("own"))
        .select(*names, "rank")
    )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = slots.value
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            order = np.argsort(length, kind="stable")
            for group in np.split(order, np.flatnonzero(np.diff(length[order])) + 1):
                if not len(group):
                    continue
                size = int(length[group[0]])
                own = table[size]
                at = own[np.searchsorted(own[:, 0], rank[group], side="right") - 1]
                beyond = rank[group] - at[:, 0]
                sequence[group] = at[:, 1] + beyond // at[:, 2]
                offset[group] = at[:, 3] + beyond % at[:, 2] * size
            columns = [batch.column(name) for name in names]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(sequence), pa.array(offset)], [*names, "sequence_id", "offset"]
            )

    schema = PIECES + (", ids array<int>" if with_ids else "") + ", sequence_id bigint, offset bigint"
    return ranked.mapInArrow(place, schema)


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id`` and ``ids`` of whole sequences, from ``pack(..., with_ids=True)``."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(parts["ids"]).alias("ids"))
