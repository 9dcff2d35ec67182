"""Benchmark decontamination with a distributed positional inverted index.

The index is partitioned by documents: one row per block of texts holds the
block's distinct words and, word by word, the places where each stands. It is
written to the shared folder and serves any number of benchmarks. A search takes
the benchmark's phrases in bounded blocks; each index block intersects the
phrases' place lists, shifted by the word's offset in the phrase, beginning with
the rarest word of the corpus.

Null and empty texts have no words and no match. A repeated document is indexed
and reported as often as it occurs; phrases that several items share count for
each of them. Items without words have no phrase. Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import ALNUM_LOWER, codes, materialize, slices, without, words

PHRASE_WORDS = 13
# Distinct phrases that one search sends to the executors; more are searched in turns.
PHRASES_AT_ONCE = 200_000

INDEX = (
    "block bigint, doc_ids array<bigint>, prints array<bigint>, first_words array<int>, terms array<string>, term_ends binary, places binary"
)
MATCHES = "block bigint, document int, phrase string, first_word int, n_words int, exact boolean"


def _index_block(number: int, part: pa.RecordBatch) -> dict:
    """Places are indices into the words of the block, ascending for each term, as steps from the one before."""
    flat, starts = words(part.column("text"), ALNUM_LOWER)
    code, terms = codes(flat)
    order = np.argsort(code, kind="stable").astype(np.int32)
    ends = np.cumsum(np.bincount(code, minlength=len(terms))).astype(np.int32)
    steps = np.diff(order, prepend=np.int32(0))
    heads = ends[:-1]
    steps[heads] = order[heads]
    return {
        "block": number,
        "doc_ids": part.column("doc_id").to_pylist(),
        "prints": part.column("print").to_pylist(),
        "first_words": starts.astype(np.int32),
        "terms": terms,
        "term_ends": ends.tobytes(),
        "places": steps.tobytes(),
    }


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number = TaskContext.get().partitionId() << 32
    types = {
        "block": pa.int64(), "doc_ids": pa.list_(pa.int64()), "prints": pa.list_(pa.int64()), "first_words": pa.list_(pa.int32()),
        "terms": pa.list_(pa.string()), "term_ends": pa.binary(), "places": pa.binary(),
    }
    for batch in batches:
        for part in slices(batch, "text"):
            row = _index_block(number, part)
            number += 1
            terms = row["terms"].cast(pa.string())
            columns = {
                **{k: pa.array([row[k]], types[k]) for k in ("block", "doc_ids", "prints", "first_words", "term_ends", "places")},
                "terms": pa.ListArray.from_arrays(pa.array([0, len(terms)], pa.int32()), terms),
            }
            yield pa.RecordBatch.from_arrays([columns[k] for k in types], list(types))


def build_index(documents: DataFrame) -> DataFrame:
    """Positional index of ``doc_id`` and ``text``, written to the shared folder.

    A document of the block ``b`` is known by ``block`` and its number therein;
    its words are those from ``first_words[number]`` up to the next entry.
    """
    text = F.col("text").cast("string")
    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("print"))
    return materialize(rows.mapInArrow(_index, INDEX), "postings")


def documents_of(index: DataFrame) -> DataFrame:
    """One row per indexed document: ``block``, ``document``, ``doc_id``, the text's hash ``print``, ``n_words``."""
    number = F.posexplode("doc_ids").alias("document", "doc_id")
    rows = index.select("block", "prints", "first_words", number)
    size = F.expr("first_words[document + 1] - first_words[document]").cast("bigint")
    return rows.select("block", "document", "doc_id", F.expr("prints[document]").alias("print"), size.alias("n_words"))


def phrases(benchmark: DataFrame, length: int = PHRASE_WORDS) -> DataFrame:
    """``phrase`` (words joined by a blank) and ``item_id``: each run of ``length`` words, or a shorter item whole."""

    def cut(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                flat, starts = words(part.column("text"), ALNUM_LOWER)
                flat, found, items = flat.to_pylist(), [], []
                for item, a, b in zip(part.column("item_id").to_pylist(), starts[:-1], starts[1:]):
                    last = max(a + 1, b - length + 1) if b > a else a
                    runs = {" ".join(flat[i : min(i + length, b)]) for i in range(a, last)}
                    found += sorted(runs)
                    items += [item] * len(runs)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found, pa.string()), pa.array(items, pa.string())], ["phrase", "item_id"]
                )

    rows = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(cut, "phrase string, item_id string")


def _term_numbers(terms: pa.Array, wanted: pa.Array) -> np.ndarray:
    """For each wanted word its number among the block's ``terms``, or -1."""
    return pc.fill_null(pc.index_in(wanted, value_set=terms), -1).to_numpy(zero_copy_only=False)


def _counts(index: DataFrame, wanted) -> dict[str, int]:
    """Occurrences in the whole corpus of the words in the broadcast ``wanted``."""

    def count(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                terms = batch.column("terms")[row].values
                ends = np.frombuffer(batch.column("term_ends")[row].as_py(), np.int32)
                at = _term_numbers(terms, wanted.value)
                here = np.flatnonzero(at >= 0)
                sizes = np.diff(ends, prepend=np.int32(0))[at[here]] if len(ends) else np.array([], np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(here, pa.int64()), pa.array(sizes, pa.int64())], ["word", "n"]
                )

    sums = index.select("terms", "term_ends").mapInArrow(count, "word bigint, n bigint").groupBy("word").agg(F.sum("n"))
    return {wanted.value[word].as_py(): n for word, n in sums.collect()}


def _align(lists: list[np.ndarray], offsets: list[int], slack: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts where every list has a place within ``slack`` of start + offset, whether all are exact, and the span."""
    start = lists[0] - offsets[0]
    exact = np.ones(len(start), bool)
    low, high = lists[0].copy(), lists[0].copy()
    for places, offset in zip(lists[1:], offsets[1:]):
        if not len(start):
            break
        target = start + offset
        right = np.minimum(np.searchsorted(places, target), len(places) - 1)
        left = np.maximum(right - 1, 0)
        nearest = np.where(np.abs(places[left] - target) < np.abs(places[right] - target), places[left], places[right])
        kept = np.abs(nearest - target) <= slack
        start, exact, nearest, target = start[kept], exact[kept], nearest[kept], target[kept]
        low, high = np.minimum(low[kept], nearest), np.maximum(high[kept], nearest)
        exact &= nearest == target
    return start, exact, low, high


def search(index: DataFrame, wanted: DataFrame, slack: int = 0) -> DataFrame:
    """Where the distinct texts of ``wanted.phrase`` stand in the indexed documents.

    ``exact`` rows are phrase matches. With ``slack`` the others are proximity
    matches: every word of the phrase stands at most so many words from its place,
    in the same document. ``first_word`` counts from the document's first word.
    """
    spark = index.sparkSession
    table = materialize(wanted.select("phrase").distinct(), "phrases")
    turns = -(-table.count() // PHRASES_AT_ONCE)
    found = spark.createDataFrame([], MATCHES)
    for turn in range(turns):
        mine = table.where(F.pmod(F.xxhash64("phrase"), F.lit(turns)) == turn)
        lines = [row.phrase for row in mine.collect()]
        found = found.unionAll(_search(index, [line.split(" ") for line in sorted(lines)], slack))
    return found


def _search(index: DataFrame, lines: list[list[str]], slack: int) -> DataFrame:
    spark = index.sparkSession
    vocabulary = sorted({word for line in lines for word in line})
    number = {word: i for i, word in enumerate(vocabulary)}
    counts = _counts(index, spark.sparkContext.broadcast(pa.array(vocabulary, pa.string())))
    # For each phrase its words, the rarest first, and their offsets; short phrases repeat their first word.
    width = max(map(len, lines), default=1)
    terms, offsets = np.zeros((len(lines), width), np.int32), np.zeros((len(lines), width), np.int32)
    sizes = np.array([len(line) for line in lines], np.int32)
    for i, line in enumerate(lines):
        order = sorted(range(len(line)), key=lambda j: (counts.get(line[j], 0), j))
        order += order[:1] * (width - len(line))
        terms[i], offsets[i] = [number[line[j]] for j in order], order
    known = np.array([all(word in counts for word in line) for line in lines], bool)
    sent = spark.sparkContext.broadcast((pa.array(vocabulary, pa.string()), terms, offsets, sizes, known, lines))

    def find(batches):
        vocabulary, terms, offsets, sizes, known, lines = sent.value
        for batch in batches:
            for row in range(batch.num_rows):
                at = _term_numbers(batch.column("terms")[row].values, vocabulary)
                hits = np.flatnonzero((at[terms] >= 0).all(axis=1) & known)
                ends = np.frombuffer(batch.column("term_ends")[row].as_py(), np.int32)
                steps = np.frombuffer(batch.column("places")[row].as_py(), np.int32)
                first = batch.column("first_words")[row].values.to_numpy(zero_copy_only=False)
                lists: dict[int, np.ndarray] = {}
                out = {k: [] for k in ("document", "phrase", "first_word", "n_words", "exact")}
                for i in hits:
                    mine = at[terms[i, : sizes[i]]]
                    for term in set(mine.tolist()) - lists.keys():
                        lists[term] = np.cumsum(steps[(ends[term - 1] if term else 0) : ends[term]])
                    start, exact, low, high = _align([lists[t] for t in mine.tolist()], offsets[i, : sizes[i]].tolist(), slack)
                    if not len(start):
                        continue
                    document = np.searchsorted(first, low, side="right") - 1
                    within = high < first[document + 1]
                    n = int(within.sum())
                    out["document"].append(document[within])
                    out["first_word"].append((np.where(exact, start, low) - first[document])[within])
                    out["n_words"].append((np.where(exact, sizes[i], high - low + 1))[within])
                    out["exact"].append(exact[within])
                    out["phrase"] += [" ".join(lines[i])] * n
                if not out["phrase"]:
                    continue
                flat = {k: np.concatenate(v) for k, v in out.items() if k != "phrase"}
                block = np.full(len(out["phrase"]), batch.column("block")[row].as_py(), np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(block),
                        pa.array(flat["document"], pa.int32()),
                        pa.array(out["phrase"], pa.string()),
                        pa.array(flat["first_word"], pa.int32()),
                        pa.array(flat["n_words"], pa.int32()),
                        pa.array(flat["exact"], pa.bool_()),
                    ],
                    ["block", "document", "phrase", "first_word", "n_words", "exact"],
                )

    return index.select("block", "first_words", "terms", "term_ends", "places").mapInArrow(find, MATCHES)


def overlap(documents: DataFrame, benchmark: DataFrame, length: int = PHRASE_WORDS, slack: int = 0) -> DataFrame:
    """One row per document: its words, words inside phrase matches, and the items they come from.

    ``n_hit`` counts each word once, however many phrases cover it. ``items`` are
    the distinct items in string order; ``n_near`` counts proximity matches that
    are no phrase match. ``block`` and ``document`` tell repeated ids apart.
    """
    wanted = materialize(phrases(benchmark, length), "benchmark")
    index = build_index(documents)
    matches = materialize(search(index, wanted, slack), "matches")
    exact = matches.where("exact")
    spans = exact.groupBy("block", "document").agg(
        F.size(
            F.array_distinct(
                F.flatten(F.collect_set(F.expr("sequence(first_word, first_word + n_words - 1)")))
            )
        ).cast("bigint").alias("n_hit")
    )
    # Written before the join, a passage of very many documents can be split there.
    found = materialize(exact.select("block", "document", "phrase").distinct(), "found")
    items = (
        found.join(wanted, "phrase").select("block", "document", "item_id").distinct()
        .groupBy("block", "document").agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    )
    near = matches.where("not exact").groupBy("block", "document").agg(F.count("*").alias("n_near"))
    key = ["block", "document"]
    rows = documents_of(index).join(spans, key, "left").join(items, key, "left").join(near, key, "left")
    none = F.array().cast("array<string>")
    return rows.select(
        "block", "document", "doc_id", "print", "n_words",
        F.coalesce("n_hit", F.lit(0).cast("bigint")).alias("n_hit"),
        F.coalesce("items", none).alias("items"),
        F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
    )


def contaminated(n_hit: str = "n_hit", n_words: str = "n_words"):
    """True for documents of which at least a twentieth of the words stands in the benchmark."""
    return (F.col(n_hit) > 0) & (20 * F.col(n_hit) >= F.col(n_words))


def without_contaminated(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``documents`` with all columns, without those contaminated; rows with a null ``doc_id`` are judged too.

    Documents are found again by id and text, so that of rows that repeat an id only those contaminated go.
    """
    found = overlap(documents, benchmark).where(contaminated())
    bad = found.select(F.col("doc_id").alias("bad_id"), F.col("print").alias("bad_print")).distinct()
    bad = materialize(bad, "contaminated")
    same = documents["doc_id"].cast("bigint").eqNullSafe(F.col("bad_id"))
    return without(documents, bad, same & (F.xxhash64(documents["text"].cast("string")) == F.col("bad_print")))
