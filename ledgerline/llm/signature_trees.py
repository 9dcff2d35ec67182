"""Exact Jaccard self-join of documents on word shingles, with signature trees.

A document's set holds its distinct runs of ``SHINGLE`` words (A-Z in lower case,
split at ASCII white space); a shorter text is one run as a whole; a text without
words has no set. Shingles are compared by 64-bit hashes. Two documents link when
their sets have a Jaccard similarity of ``PERCENT`` / 100 or more.

1. Copies: equal sets are one class, known by its smallest ``doc_id``.
2. Forest: a set is cut into ``m`` parts by hash range. Sets that link differ in
   at most (a + b) * (100 - P) / (100 + P) shingles, fewer than ``m``, so that one
   part at least is equal. Classes that share a part are put under one root; no
   link crosses roots. Sets that have fewer parts in common with all others than a
   link needs are left out of the trees.
3. Trees: below a root, classes are dealt to nodes of bounded size by size band
   and id. A node holds the range of its set sizes and the OR of its members'
   token bitmaps. Node pairs are dropped when the sizes or the number of common
   bits rule out the overlap that a link needs; both nodes of the others meet in
   one task, where a finer tree is walked in the same way down to single sets.
   Sets that reach the end are compared exactly, unless already connected there.
4. Components of the links found, over class representatives.

Null and empty texts have ``n_shingles`` 0 and are their own component. A null
``doc_id`` links with nothing and has a null component. Rows that repeat an id are
reported as often as they occur, each by its own text. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import SPACE_LOWER, codes, components, id_filter, materialize, release, slices, without, words

SHINGLE = 3
PERCENT = 90
# Near duplicates of which one document stays.
STAGE_SHINGLE = 5
STAGE_PERCENT = 80
_ROW = "_row"
BAND_RATIO = 1.25  # of the sizes that one cutting into parts serves
SPARE_PARTS = 2  # empty parts, at least, that a document may have before they count as parts
NODE_SHINGLES = 16_000  # a root's sets are dealt to nodes of about this many shingles,
NODES_PER_ROOT = 32  # or larger ones, if that made more nodes than this,
NODE_SHINGLES_MOST = 4_000_000  # up to this size (32 MB of hashes)
NODE_WORDS = 16  # 64-bit words of a node's bitmap
FANOUT = 8
PAIRS_AT_ONCE = 1 << 16

_M1, _M2, _M3, _M4 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93))
_U = np.uint64


def _mix(x: np.ndarray, salt) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ salt) * _M1
        x = (x ^ (x >> _U(32))) * _M4
        return x ^ (x >> _U(29))


@lru_cache(maxsize=None)
def _bands(most: int) -> tuple[int, ...]:
    """First sizes of the bands, up to ``most``."""
    firsts = [1]
    while firsts[-1] <= most:
        firsts.append(max(firsts[-1] + 1, int(firsts[-1] * BAND_RATIO)))
    return tuple(firsts)


@lru_cache(maxsize=None)
def _parts_of_band(band: int, percent: int) -> tuple[int, int]:
    """Number of parts under which the sets of a band are cut, and how many of them may be empty; 0 where only equal sets link.

    Linked sets differ in at most so many parts that one more than the spare ones
    are equal. So a set with no more empty parts than that needs no key for them; the
    spare parts are half as many again as the smallest sets have empty on average.
    """
    firsts = _bands(1 << 40)
    differ = (2 * (firsts[band + 1] - 1) * (100 - percent)) // (100 + percent)
    if not differ:
        return 0, 0
    lowest, spare = firsts[band] * percent / 100, SPARE_PARTS
    for _ in range(6):
        m = differ + 1 + spare
        spare = SPARE_PARTS + int(1.5 * m * np.exp(-lowest / m))
    return differ + 1 + spare, spare


def _schemes(n: int, percent: int) -> list[tuple[int, int, int]]:
    """(band, parts, spare parts) under which a set of ``n`` shingles is cut: its own band, and the next if it may link into it."""
    firsts = _bands(1 << 40)
    band = int(np.searchsorted(firsts, n, side="right")) - 1
    bands = [band]
    while firsts[bands[-1] + 1] * percent <= 100 * n:
        bands.append(bands[-1] + 1)
    found = ((band, *_parts_of_band(band, percent)) for band in bands)
    return [x for x in found if x[1]]


@lru_cache(maxsize=4096)
def _edges(m: int) -> np.ndarray:
    return np.array([((j << 64) + m - 1) // m for j in range(1, m)], dtype=np.uint64)


def _parts(hashes: np.ndarray, percent: int) -> tuple[np.ndarray, tuple[int, int]]:
    """Keys of the parts of one ascending set of hashes, and how many of them it has in common with any set it links with.

    Bands are told apart by the lowest bit of a key, of which neighbours have
    different ones; the second result is by that bit, 0 where the set is not cut.
    """
    least = [0, 0]
    with np.errstate(over="ignore"):
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_mix(hashes, _M2))))
        keys = [np.zeros(0, np.uint64)]
        for band, m, spare in _schemes(len(hashes), percent):
            cuts = np.concatenate(([0], np.searchsorted(hashes, _edges(m)), [len(hashes)]))
            full = cuts[1:] > cuts[:-1]
            part = np.where(full, sums[cuts[1:]] - sums[cuts[:-1]], _M3)
            key = _mix(part, _M3) + _mix(np.arange(m, dtype=np.uint64), _U(band) * _M2 + _U(m))
            empty = int((~full).sum())
            keys.append(((key[full] if empty <= spare else key) & ~_U(1)) | _U(band & 1))
            # All but the parts that differ are equal, one more than the spare ones. Less those empty here, or, where
            # empty ones have keys, in the other set, all of them have a common key.
            least[band & 1] = spare + 1 - min(empty, spare)
    return np.concatenate(keys), tuple(least)


def shingle_hashes(part: pa.RecordBatch, length: int) -> list[np.ndarray]:
    """For each row of ``part`` the ascending distinct hashes of its shingles."""
    flat, starts = words(part.column("text"), SPACE_LOWER)
    code, values = codes(flat)
    known = np.array([xxhash.xxh3_64_intdigest(w) for w in values.to_pylist()], dtype=np.uint64)
    h = known[code] if len(values) else np.zeros(0, np.uint64)
    out = []
    with np.errstate(over="ignore"):
        runs = np.zeros(max(0, len(h) - length + 1), np.uint64)
        for k in range(length):
            runs = (runs + h[k : k + len(runs)]) * _M1
            runs ^= runs >> _U(31)
        for a, b in zip(starts[:-1], starts[1:]):
            if b - a >= length:
                out.append(np.unique(runs[a : b - length + 1]))
            elif b > a:
                whole = np.zeros(1, np.uint64) + _U(b - a)
                for k in range(a, b):
                    whole = _mix(whole + h[k], _M2)
                out.append(whole)
            else:
                out.append(np.zeros(0, np.uint64))
    return out


def _fingerprint(hashes: np.ndarray) -> tuple[int, int]:
    if not len(hashes):
        return 0, 0
    return tuple(int(x) for x in np.array([_mix(hashes, _M3).sum(), np.bitwise_xor.reduce(_mix(hashes, _M4))]).view(np.int64))


def _rows(documents: DataFrame) -> DataFrame:
    return documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))


def _measured(documents: DataFrame, length: int, percent: int) -> DataFrame:
    """``doc_id``, ``n``, fingerprint, part keys, and ``mates``: fingerprints of sets that share a part.

    A set seen before in the same task has no keys. Of the sets of a slice that
    share a part only the first has its key, in ``common``; the others name it as a
    mate. So a part of very many documents has a row for each slice and not for each
    of them. ``alone`` are the keys that no other set of the slice has. ``met`` counts
    the set's keys that others of the slice have, and ``least`` those that a link
    needs, each by the lowest bit.
    """

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in batches:
            for part in slices(batch, "text"):
                sets = shingle_hashes(part, length)
                prints = [_fingerprint(x) for x in sets]
                keys, least = [], []
                for x, p in zip(sets, prints):
                    own = (np.zeros(0, np.uint64), (0, 0)) if p in seen or not len(x) else _parts(x, percent)
                    keys.append(own[0])
                    least.append(own[1])
                    seen.add(p)
                alone, common, mates, met = _first_of_each(keys, np.array([p[0] for p in prints], np.int64))
                bits = lambda x, bit: pa.array([y[bit] for y in x], pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array([len(x) for x in sets], pa.int64()),
                        pa.array([p[0] for p in prints], pa.int64()),
                        pa.array([p[1] for p in prints], pa.int64()),
                        _lists(alone),
                        _lists(common),
                        _lists(mates),
                        bits(met, 0), bits(met, 1), bits(least, 0), bits(least, 1),
                    ],
                    ["doc_id", "n", "p1", "p2", "alone", "common", "mates", "met0", "met1", "least0", "least1"],
                )

    schema = (
        "doc_id bigint, n bigint, p1 bigint, p2 bigint, alone array<bigint>, common array<bigint>, mates array<bigint>, "
        "met0 int, met1 int, least0 int, least1 int"
    )
    return _rows(documents).mapInArrow(measure, schema)


def _lists(rows: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, rows)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(rows).view(np.int64)))


def _first_of_each(keys: list[np.ndarray], prints: np.ndarray) -> tuple[list, list, list, list[tuple[int, int]]]:
    """By row: keys of no other row, keys that it is the first of several to have, prints of the first ones of its other keys,
    and how many of its keys other rows have too, by the lowest bit."""
    row = np.repeat(np.arange(len(keys)), [len(x) for x in keys])
    flat = np.concatenate(keys)
    _, first, number, times = np.unique(flat, return_index=True, return_inverse=True, return_counts=True)
    leader, several = row[first][number], times[number] > 1
    own = np.zeros(len(flat), bool)
    own[first] = True
    cuts = np.cumsum([len(x) for x in keys])[:-1]
    parts = (np.split(x, cuts) for x in (own, leader, several))
    alone, common, mates, met = [], [], [], []
    for i, (x, mine, theirs, many) in enumerate(zip(keys, *parts)):
        alone.append(x[~many])
        common.append(x[mine & many])
        mates.append(np.unique(prints[theirs[theirs != i]]))
        odd = int((x[many] & _U(1)).sum())
        met.append((int(many.sum()) - odd, odd))
    return alone, common, mates, met


def _contents(documents: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """``doc_id``, fingerprint, hashes, bitmap and its bits, of the documents ``wanted`` and maybe some others.

    A filter of the ids wanted, of bounded size, spares a shuffle of all texts.
    """
    known = id_filter(wanted)
    if known is None:
        documents = documents.join(wanted, "doc_id", "left_semi")

    def content(batches):
        for batch in batches:
            batch = batch.filter(pc.is_valid(batch.column("doc_id")))
            if known is not None:
                ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
                batch = batch.filter(pa.array(known.value.may_hold(ids)))
            for part in slices(batch, "text"):
                sets = shingle_hashes(part, length)
                prints = [_fingerprint(x) for x in sets]
                maps = _bitmaps(sets, NODE_WORDS) if sets else np.zeros((0, NODE_WORDS), np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array([p[0] for p in prints], pa.int64()),
                        pa.array([p[1] for p in prints], pa.int64()),
                        pa.array([x.tobytes() for x in sets], pa.binary()),
                        pa.FixedSizeListArray.from_arrays(pa.array(maps.view(np.int64).ravel()), NODE_WORDS).cast(pa.list_(pa.int64())),
                        pa.array(np.bitwise_count(maps).sum(axis=1).astype(np.int64)),
                    ],
                    ["doc_id", "p1", "p2", "hashes", "bits", "n_bits"],
                )

    return _rows(documents).mapInArrow(
        content, "doc_id bigint, p1 bigint, p2 bigint, hashes binary, bits array<bigint>, n_bits bigint"
    )


def _bitmaps(sets: list[np.ndarray], n_words: int) -> np.ndarray:
    """Token bitmaps: each hash sets one of 64 * ``n_words`` bits (a power of two)."""
    maps = np.zeros((len(sets), n_words), np.uint64)
    row = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    bit = np.concatenate(sets) & _U(64 * n_words - 1) if len(sets) else np.zeros(0, np.uint64)
    np.bitwise_or.at(maps, (row, (bit >> _U(6)).astype(np.int64)), _U(1) << (bit & _U(63)))
    return maps


class _Links:
    """Disjoint sets of the rows of one task."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = x = self.up[self.up[x]]
        return x


def walk(sets: list[np.ndarray], side: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Links among ``sets`` (rows of side 0 with those of side 1, or all if there is one side), as a spanning forest.

    The signature tree stands on the sets in order of size; pairs of its nodes are
    walked from the root and dropped when no two members can have the overlap.
    """
    n = np.array([len(x) for x in sets], np.int64)
    order = np.lexsort((np.array([int(x[0]) if len(x) else 0 for x in sets], np.uint64), n))
    sets, n, side = [sets[i] for i in order], n[order], side[order]
    width = 1 << int(np.ceil(np.log2(max(8, min(1024, int(n.max()) / 8)))))
    maps = _bitmaps(sets, width)
    both = bool(side.min() != side.max())
    # A partner lacks at most the hundredth parts beyond `percent` of the larger set.
    spare = n * (100 - percent) // 100
    levels = [(maps, np.bitwise_count(maps).sum(axis=1).astype(np.int64) - spare, n, n, side == 0, side == 1)]
    while len(levels[-1][0]) > 1:
        m, need, low, high, left, right = levels[-1]
        at = np.arange(0, len(m), FANOUT)
        levels.append((
            np.bitwise_or.reduceat(m, at), np.minimum.reduceat(need, at), np.minimum.reduceat(low, at),
            np.maximum.reduceat(high, at), np.logical_or.reduceat(left, at), np.logical_or.reduceat(right, at),
        ))
    links, found = _Links(len(sets)), []
    stack = [(len(levels) - 1, np.zeros(1, np.int64), np.zeros(1, np.int64))]
    while stack:
        level, a, b = stack.pop()
        m, need, low, high, left, right = levels[level]
        may = (100 * high[a] >= percent * low[b]) & (100 * high[b] >= percent * low[a])
        if both:
            may &= (left[a] & right[b]) | (right[a] & left[b])
        a, b = a[may], b[may]
        common = np.bitwise_count(m[a] & m[b]).sum(axis=1).astype(np.int64)
        may = (common >= need[a]) & (common >= need[b])
        a, b = a[may], b[may]
        if level:
            step = np.arange(FANOUT)
            below = len(levels[level - 1][0])
            x = (a[:, None] * FANOUT + step)[:, :, None] + np.zeros((1, 1, FANOUT), np.int64)
            y = (b[:, None] * FANOUT + step)[:, None, :] + np.zeros((1, FANOUT, 1), np.int64)
            x, y = x.ravel(), y.ravel()
            ok = (x < below) & (y < below) & ((x < y) if level == 1 else (x <= y))
            x, y = x[ok], y[ok]
            stack += [(level - 1, x[i : i + PAIRS_AT_ONCE], y[i : i + PAIRS_AT_ONCE]) for i in range(0, len(x), PAIRS_AT_ONCE)]
            continue
        for i, j in zip(a.tolist(), b.tolist()):
            u, v = links.root(i), links.root(j)
            if u == v:
                continue
            overlap = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
            if 100 * overlap >= percent * (n[i] + n[j] - overlap):
                links.up[u] = v
                found.append((int(order[i]), int(order[j])))
    return found


def _units(members: DataFrame, contents: DataFrame, percent: int) -> tuple[DataFrame, list[DataFrame]]:
    """Rows ``unit``, ``side``, ``doc_id``, ``hashes``: node pairs that may hold links, with both nodes' sets; and the tables read."""
    # Written before the joins, the rows of a root with very many classes can be split there.
    totals = materialize(members.groupBy("root").agg(F.sum("n").alias("total")), "tree-sizes")
    capacity = F.greatest(F.lit(NODE_SHINGLES), F.least(F.lit(NODE_SHINGLES_MOST), F.floor(F.col("total") / NODES_PER_ROOT)))
    band = F.when(F.col("total") <= NODE_SHINGLES, 0).otherwise(F.floor(F.log(F.col("n")) / F.log(F.lit(100 / percent))))
    placed = members.join(totals, "root").select("root", "doc_id", "p1", "p2", "n", band.alias("band"), capacity.alias("capacity"))
    sizes = placed.groupBy("root", "band").agg(F.ceil(F.sum("n") / F.first("capacity")).alias("slots"))
    sizes = materialize(sizes, "tree-slots")
    slot = F.pmod(F.xxhash64("doc_id"), F.col("slots")).alias("slot")
    placed = placed.join(sizes, ["root", "band"]).select("root", "band", slot, "doc_id", "p1", "p2", "n")
    leaves = materialize(
        placed.join(contents, ["doc_id", "p1", "p2"]).withColumn("node", F.xxhash64("root", "band", "slot")), "tree-leaves"
    )
    spare = F.floor(F.col("n") * (100 - percent) / 100)
    nodes = leaves.groupBy("root", "band", "slot", "node").agg(
        F.min("n").alias("low"), F.max("n").alias("high"), F.min(F.col("n_bits") - spare).alias("need"),
        F.array(*(F.bit_or(F.col("bits")[i]) for i in range(NODE_WORDS))).alias("bits"),
    )
    nodes = materialize(nodes, "tree-nodes")
    left = nodes.select("root", "band", *(F.col(c).alias(f"{c}_a") for c in ("slot", "node", "low", "high", "need", "bits")))
    right = nodes.withColumn("next", F.explode(F.array(F.col("band"), F.col("band") - 1))).select(
        "root", F.col("next").alias("band"), F.col("band").alias("band_b"),
        *(F.col(c).alias(f"{c}_b") for c in ("slot", "node", "low", "high", "need", "bits")),
    )
    common = F.expr("aggregate(zip_with(bits_a, bits_b, (x, y) -> bit_count(x & y)), 0, (s, x) -> s + x)")
    pairs = (
        left.join(right, ["root", "band"])
        .where("band_b > band or slot_a <= slot_b")
        .where((100 * F.col("high_a") >= percent * F.col("low_b")) & (100 * F.col("high_b") >= percent * F.col("low_a")))
        .where((common >= F.col("need_a")) & (common >= F.col("need_b")))
        .select("node_a", "node_b", F.xxhash64("node_a", "node_b").alias("unit"))
    )
    sides = materialize(
        pairs.select(
            "unit",
            F.explode(
                F.when(F.col("node_a") == F.col("node_b"), F.array(F.struct(F.lit(0).alias("side"), F.col("node_a").alias("node"))))
                .otherwise(F.array(
                    F.struct(F.lit(0).alias("side"), F.col("node_a").alias("node")),
                    F.struct(F.lit(1).alias("side"), F.col("node_b").alias("node")),
                ))
            ).alias("x"),
        ).select("unit", "x.side", "x.node"),
        "tree-pairs",
    )
    units = sides.join(leaves.select("node", "doc_id", "hashes"), "node").select("unit", "side", "doc_id", "hashes")
    release(totals, sizes, nodes)
    return units, [leaves, sides]


def links(documents: DataFrame, measured: DataFrame, length: int, percent: int) -> tuple[DataFrame, list[DataFrame]]:
    """Links ``a``, ``b`` between class representatives that connect all linked documents, and the tables they are read from."""
    classes = (
        measured.where("doc_id is not null and n > 0").groupBy("p1", "p2", "n").agg(F.min("doc_id").alias("doc_id"))
    )
    one = lambda name: F.transform(name, lambda k: F.struct(k.alias("key"), F.lit(name == "alone").alias("alone")))
    parts = measured.select("p1", F.explode(F.concat(one("alone"), one("common"))).alias("x")).select("p1", "x.*")
    within = Window.partitionBy("key")
    parts = parts.select(F.min("p1").over(within).alias("a"), F.max("p1").over(within).alias("z"), F.col("p1").alias("b"), "key", "alone")
    parts = materialize(parts.where("a <> z").groupBy("a", "b").agg(
        *(F.sum((F.col("alone") & (F.col("key").bitwiseAND(1) == bit)).cast("int")).alias(f"met{bit}") for bit in (0, 1))
    ), "tree-shared")
    # Sets with fewer keys in common with others than a link needs have no link; they only hold the forest together.
    met = parts.select(F.col("b").alias("p1"), "met0", "met1").unionAll(measured.select("p1", "met0", "met1"))
    met = met.groupBy("p1").agg(F.sum("met0").alias("met0"), F.sum("met1").alias("met1"))
    needs = measured.where("least0 + least1 > 0").groupBy("p1").agg(F.min("least0").alias("least0"), F.min("least1").alias("least1"))
    enough = met.join(needs, "p1").where("(least0 > 0 and met0 >= least0) or (least1 > 0 and met1 >= least1)").select("p1")
    shared = parts.select("a", "b").unionAll(measured.select("p1", F.explode("mates"))).where("a <> b").distinct()
    forest = components(shared, "forest")
    roots = forest.select(F.col("node").alias("p1"), F.col("component").alias("root"))
    members = classes.join(enough, "p1").join(roots, "p1").select("root", "doc_id", "p1", "p2", "n")
    members = materialize(members, "tree-members")
    release(forest, parts)
    units, scratch = _units(members, _contents(documents, members.select("doc_id").distinct(), length), percent)

    def compare(batch: pa.Table) -> pa.Table:
        ids = batch.column("doc_id").to_pylist()
        sets = [np.frombuffer(x, np.uint64) for x in batch.column("hashes").to_pylist()]
        found = walk(sets, batch.column("side").to_numpy(), percent)
        return pa.table({"a": pa.array([ids[i] for i, _ in found], pa.int64()), "b": pa.array([ids[j] for _, j in found], pa.int64())})

    return units.groupBy("unit").applyInArrow(compare, "a bigint, b bigint"), [members, *scratch]


def near_duplicates(documents: DataFrame, length: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row per document: ``doc_id``, ``n_shingles``, ``component_id`` (the smallest linked ``doc_id``)."""
    measured = materialize(_measured(documents, length, percent), "shingles")
    linked, scratch = links(documents, measured, length, percent)
    found = components(linked, "links")
    classes = (
        measured.where("doc_id is not null and n > 0").groupBy("p1", "p2", "n").agg(F.min("doc_id").alias("class"))
        .join(found, F.col("class") == F.col("node"), "left")
        .select("p1", "p2", "n", F.coalesce("component", "class").alias("component_id"))
    )
    classes = materialize(classes, "classes")
    release(found, *scratch)
    rows = measured.select("doc_id", "p1", "p2", "n")
    return rows.join(classes, ["p1", "p2", "n"], "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNull(), F.lit(None)).when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    )


def one_of_each(documents: DataFrame, length: int = STAGE_SHINGLE, percent: int = STAGE_PERCENT) -> DataFrame:
    """``documents`` with all columns, of each component only the row with the smallest ``doc_id``.

    Rows with a null id all stay. Rows are told apart by more than their ids: of
    rows that repeat an id only those linked with each other give way to one.
    """
    ids = documents.select(F.col("doc_id").cast("bigint").alias("doc_id")).where("doc_id is not null")
    if ids.groupBy("doc_id").count().where("count > 1").isEmpty():
        found = materialize(near_duplicates(documents, length, percent), "components")
        others = materialize(found.where("doc_id <> component_id").select("doc_id"), "others")
        release(found)
        return without(documents, others)
    # Written with a number of its own, every row is a document by itself.
    rows = materialize(documents.withColumn(_ROW, F.monotonically_increasing_id()), "numbered")
    known = rows.where("doc_id is not null").select(F.col(_ROW).alias("doc_id"), "text")
    found = near_duplicates(known, length, percent).select(F.col("doc_id").alias("row"), F.col("component_id").alias("component"))
    found = materialize(found.join(rows.select(F.col(_ROW).alias("row"), F.col("doc_id").cast("bigint").alias("doc_id")), "row"), "components")
    first = found.groupBy("component").agg(F.min(F.struct("doc_id", "row")).alias("first"))
    others = found.join(first, "component").where("row <> first.row").select("row")
    others = materialize(others, "others")
    release(found)
    return without(rows, others, F.col(_ROW) == F.col("row")).drop(_ROW)
