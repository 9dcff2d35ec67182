"""Phrase collocations: exact phrase counts by burst tries, scored by their weakest cut.

Texts (A-Z in lower case) are parted into pieces at ``.,;:!?`` and line ends, and
those into words at blanks and tabs. Each task counts the phrases of its texts in a
HAT-trie: the words' numbers are the symbols, each container is a hash table of the
phrases below one prefix, or a range of prefixes. A container that grows too large
bursts, at the shallowest word that parts it. When the trie holds ``MOST_ENTRIES``
phrases, its largest subtrees are written out as sorted runs and their memory is
freed. Runs of all tasks lie in a table; they are merged by ranges of the sorted
phrases, so that every range is a set of whole prefixes and a common prefix is cut
at its second or third word.

Phrases of one and two words are counted first. Of three words only those are
counted of which both halves may be frequent, by a Bloom filter of the frequent
pairs; it never rejects a phrase whose parts are frequent, so counts are exact.

Null texts count as empty and have no words; a null ``lang`` is ``und``. Repeated
rows count as often as they occur. Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import IdFilter, byte_map, codes, materialize, release, slices, words

LEAST = 10
ABSORBED_PERCENT = 50
RANKED = 2000
SALTS = 64  # parts in which a language's phrases are ranked before they meet

SYMBOL_BITS = 21  # of a word's number in a phrase's key; three fit
MOST_WORDS = 300_000  # of a task's vocabulary, some 75 MB; beyond that it spills all and starts anew
BURST = 1 << 16  # phrases of a container
MOST_ENTRIES = 1_500_000  # phrases of a task's trie, some 90 MB
SLICE_BYTES = 4 << 20  # of text at once
FILTER_BITS = 1 << 27  # of the filter of frequent pairs at most, 16 MB

RUNS = "lang string, phrase string, f bigint"
JOINED = "\t"  # between the words of a phrase in a run; no word holds it
_MASK = (1 << SYMBOL_BITS) - 1
_EMPTY = np.int64(-1)

# Byte table: A-Z in lower case, ends of pieces as blanks.
_PIECE_ENDS = np.frombuffer(b".,;:!?\n\x0b\x0c\r", np.uint8)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_LOWER[_PIECE_ENDS] = 32
_IS_END = np.zeros(256, bool)
_IS_END[_PIECE_ENDS] = True


class Container:
    """A hash table of phrase keys of ``low`` or more, and their counts."""

    def __init__(self, low: int, size: int = 1 << 10):
        self.low, self.n = low, 0
        self.keys, self.counts = np.full(size, _EMPTY), np.zeros(size, np.int64)

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        """Adds counts of different keys."""
        while 2 * (self.n + len(keys)) > len(self.keys):
            old, n = self.sorted(), len(self.keys)
            self.n, self.keys, self.counts = 0, np.full(4 * n, _EMPTY), np.zeros(4 * n, np.int64)
            self._put(*old)
        self._put(keys, counts)

    def _put(self, keys: np.ndarray, counts: np.ndarray) -> None:
        last = len(self.keys) - 1
        mixed = np.ascontiguousarray(keys).view(np.uint64)
        with np.errstate(over="ignore"):
            mixed = (mixed ^ (mixed >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
            mixed = (mixed ^ (mixed >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        at = (mixed >> np.uint64(31)).astype(np.int64) & last
        while len(keys):
            free = self.keys[at] == _EMPTY
            self.keys[at[free]] = keys[free]  # of keys that want one place the last gets it
            own = self.keys[at] == keys
            self.n += int((free & own).sum())
            self.counts[at[own]] += counts[own]
            keys, counts, at = keys[~own], counts[~own], (at[~own] + 1) & last

    def sorted(self) -> tuple[np.ndarray, np.ndarray]:
        full = self.keys != _EMPTY
        keys, counts = self.keys[full], self.counts[full]
        order = np.argsort(keys)
        return keys[order], counts[order]


def _cut(keys: np.ndarray) -> int:
    """The first key of the right part: the shallowest prefix that begins between the outer quarters of sorted ``keys``."""
    first, last = int(keys[len(keys) // 4]), int(keys[3 * len(keys) // 4])
    for symbol in range(2, -1, -1):
        shift = symbol * SYMBOL_BITS
        if first >> shift != last >> shift:
            middle = max(int(keys[len(keys) // 2]) >> shift, (first >> shift) + 1)
            return middle << shift
    return last


class HatTrie:
    """Counts of phrase keys in containers, each for a range of prefixes, in order."""

    def __init__(self, burst: int = BURST):
        self.burst, self.containers = burst, [Container(0)]

    @property
    def entries(self) -> int:
        return sum(c.n for c in self.containers)

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        """Adds the counts of sorted, different keys."""
        cuts = np.searchsorted(keys, [c.low for c in self.containers[1:]])
        grown: list[Container] = []
        for container, own, more in zip(self.containers, np.split(keys, cuts), np.split(counts, cuts)):
            if len(own):
                container.add(own, more)
            grown += self._parts(container) if container.n > self.burst else [container]
        self.containers = grown

    def _parts(self, container: Container) -> list[Container]:
        """What a container bursts into."""
        todo, out = [(container.low, *container.sorted())], []
        while todo:
            low, keys, counts = todo.pop()
            if len(keys) > self.burst:
                cut = _cut(keys)
                at = int(np.searchsorted(keys, cut))
                if 0 < at < len(keys):
                    todo += [(cut, keys[at:], counts[at:]), (low, keys[:at], counts[:at])]
                    continue
            part = Container(low, 1 << max(10, int(2.5 * len(keys)).bit_length()))
            part.add(keys, counts)
            out.append(part)
        return out

    def spill(self, left: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The largest subtrees, as sorted keys and counts, until at most ``left`` entries stay."""
        total = self.entries
        for i in sorted(range(len(self.containers)), key=lambda i: -self.containers[i].n):
            if total <= left or not self.containers[i].n:
                break
            total -= self.containers[i].n
            yield self.containers[i].sorted()
            self.containers[i] = Container(self.containers[i].low)


class Vocabulary:
    """Numbers, from 1, of a task's words by language."""

    def __init__(self):
        self.number: dict[tuple[str, str], int] = {}

    def numbers(self, langs: list[str], found: list[str]) -> np.ndarray:
        keys = list(zip(langs, found))
        out = list(map(self.number.get, keys))
        for i, known in enumerate(out):
            if known is None:
                out[i] = self.number[keys[i]] = len(self.number) + 1
        return np.array(out, np.int64)

    def ordered(self) -> tuple[np.ndarray, pa.Array, pa.Array]:
        """Each number's place among the sorted words, from 1, and the sorted words with their languages."""
        langs = pa.array([x[0] for x in self.number], pa.string())
        texts = pa.array([x[1] for x in self.number], pa.string())
        order = pc.sort_indices(pa.table([langs, texts], ["lang", "word"]), sort_keys=[("lang", "ascending"), ("word", "ascending")])
        rank = np.zeros(len(order) + 1, np.int64)
        rank[order.to_numpy().astype(np.int64) + 1] = np.arange(1, len(order) + 1)
        return rank, langs.take(order), texts.take(order)


def sorted_run(keys: np.ndarray, counts: np.ndarray, rank: np.ndarray, langs: pa.Array, texts: pa.Array) -> pa.RecordBatch:
    """Phrases with their words, sorted by them."""
    parts = [rank[(keys >> (symbol * SYMBOL_BITS)) & _MASK] for symbol in (2, 1, 0)]
    packed = (parts[0] << (2 * SYMBOL_BITS)) | (parts[1] << SYMBOL_BITS) | parts[2]
    order = np.argsort(packed)
    columns = [langs.take(pa.array(parts[0][order] - 1))]
    for part in parts:
        at = part[order]
        columns.append(texts.take(pa.array(at - 1, mask=at == 0)))
    return pa.RecordBatch.from_arrays([*columns, pa.array(counts[order])], ["lang", "w1", "w2", "w3", "f"])


def piece_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """All words of ``texts``, each one's text, and whether it goes on in the piece of the word before."""
    texts = pc.fill_null(texts, "").cast(pa.string())
    flat, starts = words(texts, _LOWER)
    row = np.repeat(np.arange(len(texts)), np.diff(starts))
    if not len(flat):
        return flat, row, np.zeros(0, bool)
    ends = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(texts.buffers()[2], np.uint8)[ends[0] : ends[-1]]
    inside = _LOWER[raw]
    inside = (inside != 32) & (inside != 9)
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    heads = ends[:-1] - ends[0]
    heads = heads[heads < len(inside)]
    begins[heads] = inside[heads]
    marks = np.cumsum(_IS_END[raw])[np.flatnonzero(begins)]
    goes_on = np.concatenate(([False], (marks[1:] == marks[:-1]) & (row[1:] == row[:-1])))
    return flat, row, goes_on


def word_hashes(langs: list[str], found: list[str]) -> np.ndarray:
    """A hash of each word of a language."""
    hashes = (xxhash.xxh3_64_intdigest(f"{lang}\n{word}") for lang, word in zip(langs, found))
    return np.fromiter(hashes, np.uint64, len(found))


def pair_hashes(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Hashes of two words from the words' hashes."""
    with np.errstate(over="ignore"):
        return (first * np.uint64(0x9E3779B97F4A7C15) + second * np.uint64(0xC2B2AE3D27D4EB4F)).view(np.int64)


class Counter:
    """Counts the phrases of a task's texts and yields sorted runs."""

    def __init__(self, frequent: IdFilter | None = None, most: int = MOST_ENTRIES, burst: int = BURST, most_words: int = MOST_WORDS):
        self.frequent, self.most, self.burst, self.most_words = frequent, most, burst, most_words
        self._start()
        self.n_words: dict[str, int] = {}

    def _start(self) -> None:
        self.trie, self.vocabulary = HatTrie(self.burst), Vocabulary()

    def _runs(self, left: int) -> Iterator[pa.RecordBatch]:
        ordered = None
        for keys, counts in self.trie.spill(left):
            ordered = ordered or self.vocabulary.ordered()
            yield sorted_run(keys, counts, *ordered)

    def add(self, part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        """Counts a slice; yields what the trie gives up for it."""
        flat, row, goes_on = piece_words(part.column("text"))
        if not len(flat):
            return
        code, values = codes(flat)
        lang, langs = codes(pc.fill_null(part.column("lang").cast(pa.string()), "und"))
        both = code.astype(np.int64) * len(langs) + lang[row]
        inverse, distinct = pd.factorize(both)
        langs = langs.to_pylist()
        for name, n in zip(langs, np.bincount(lang[row], minlength=len(langs)).tolist()):
            self.n_words[name] = self.n_words.get(name, 0) + n
        two = np.flatnonzero(goes_on[1:])  # words that another follows
        spelt = lambda at: ([langs[i] for i in (at % len(langs)).tolist()], values.take(pa.array(at // len(langs))).to_pylist())
        if self.frequent is None:
            # Every word begins a phrase of one, and of two where another follows.
            begins, length = np.concatenate((np.arange(len(inverse)), two)), np.repeat([1, 2], [len(inverse), len(two)])
            used = np.arange(len(distinct))
        else:
            hashes = word_hashes(*spelt(distinct))[inverse]
            may = self.frequent.may_hold(pair_hashes(hashes[two], hashes[two + 1])) if len(two) else np.zeros(0, bool)
            begins = two[:-1][(np.diff(two) == 1) & may[:-1] & may[1:]]
            length = np.full(len(begins), 3)
            used = np.unique(inverse[begins[:, None] + np.arange(3)])
        if not len(begins):
            return
        if len(self.vocabulary.number) + len(used) > self.most_words:
            yield from self._runs(0)
            self._start()
        number = np.zeros(len(distinct), np.int64)
        number[used] = self.vocabulary.numbers(*spelt(distinct[used]))
        number = np.concatenate((number[inverse], np.zeros(2, np.int64)))
        keys = number[begins] << (2 * SYMBOL_BITS)
        for place in (1, 2):
            more = length > place
            keys[more] |= number[begins[more] + place] << ((2 - place) * SYMBOL_BITS)
        keys, counts = np.unique(keys, return_counts=True)
        self.trie.add(keys, counts.astype(np.int64))
        if self.trie.entries > self.most:
            yield from self._runs(self.most // 4)

    def finish(self) -> Iterator[pa.RecordBatch]:
        yield from self._runs(0)
        if self.n_words and self.frequent is None:
            # The empty phrase occurs with every word.
            langs = sorted(self.n_words)
            none = pa.nulls(len(langs), pa.string())
            columns = [pa.array(langs, pa.string()), none, none, none, pa.array([self.n_words[x] for x in langs], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "w1", "w2", "w3", "f"])


def joined(run: pa.RecordBatch) -> pa.RecordBatch:
    """A run with each phrase as one text, empty for the empty phrase: one column to move, sort and group by."""
    first = pc.fill_null(run.column("w1"), "")
    phrase = pc.binary_join_element_wise(first, run.column("w2"), run.column("w3"), JOINED, null_handling="skip")
    return pa.RecordBatch.from_arrays([run.column("lang"), phrase, run.column("f")], ["lang", "phrase", "f"])


def _runs(documents: DataFrame, frequent=None, **limits: int) -> DataFrame:
    """The sorted runs of all tasks: phrases and counts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(frequent.value if frequent else None, **limits)
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                yield from map(joined, counter.add(part))
        yield from map(joined, counter.finish())

    rows = documents.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    return materialize(rows.mapInArrow(count, RUNS), "phrase-runs")


def _merged(runs: DataFrame, least: int) -> DataFrame:
    """Phrases of all runs with their counts, of ``least`` occurrences at least, merged by ranges of prefixes.

    Words are null beyond the phrase's end.
    """
    key = ["lang", "phrase"]
    merged = runs.repartitionByRange(*key).groupBy(*key).agg(F.sum("f").alias("f"))
    kept = merged.where((F.col("f") >= least) | (F.col("phrase") == ""))
    parts = F.split(F.nullif("phrase", F.lit("")), JOINED)
    return kept.select("lang", *(F.get(parts, F.lit(i)).alias(f"w{i + 1}") for i in range(3)), "f")


def _pair_filter(pairs: DataFrame):
    """A broadcast filter of pairs; it grows with their number up to ``FILTER_BITS``."""
    n = pairs.count()
    made = IdFilter(min(FILTER_BITS, 1 << max(10, (16 * n - 1).bit_length())))

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, *both = (batch.column(c).to_pylist() for c in ("lang", "w1", "w2"))
            word, bit = made.places(pair_hashes(*(word_hashes(langs, x) for x in both)))
            yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(bit.view(np.int64))], ["word", "bits"])

    rows = pairs.mapInArrow(put, "word bigint, bits bigint").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    made.words[rows.column("word").to_numpy()] = rows.column("bits").to_numpy().view(np.uint64)
    return pairs.sparkSession.sparkContext.broadcast(made)


def phrase_counts(documents: DataFrame, least: int = LEAST, **limits: int) -> DataFrame:
    """``lang``, ``w1`` to ``w3`` and ``f`` of phrases of one to three words that occur ``least`` times at least.

    The empty phrase (``w1`` null) has a language's number of words, however many.
    """
    runs = _runs(documents, **limits)
    short = materialize(_merged(runs, least), "phrases")
    release(runs)
    frequent = _pair_filter(short.where("w2 is not null").select("lang", "w1", "w2"))
    runs = _runs(documents, frequent, **limits)
    long = materialize(_merged(runs, least), "long-phrases")
    release(runs)
    return short.unionAll(long)


def _score(a: str, left: str, right: str) -> Column:
    """floor(1000000 a a / (left right)) in whole numbers of up to 38 digits."""
    wide = "cast({} as decimal(14,0))".format
    over = f"cast({wide(a)} * {wide(a)} as decimal(28,0)) * cast(1000000 as decimal(7,0))"
    return F.expr(f"{over} div ({wide(left)} * {wide(right)})")


def collocations(documents: DataFrame, ranked: int = RANKED, least: int = LEAST, **limits: int) -> DataFrame:
    """Each language's first phrases by score: ``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``."""
    counts = phrase_counts(documents, least, **limits)
    part = lambda *names: counts.where(
        F.col("w1").isNotNull() & (F.col("w2").isNotNull() if len(names) > 2 else F.col("w2").isNull()) & F.col("w3").isNull()
    ).select("lang", *(F.col(f"w{i + 1}").alias(x) for i, x in enumerate(names[:-1])), F.col("f").alias(names[-1]))
    pairs = counts.where("w2 is not null and w3 is null").select("lang", "w1", "w2", F.col("f").alias("a"))
    triples = counts.where("w3 is not null").select("lang", "w1", "w2", "w3", F.col("f").alias("a"))
    pairs = pairs.join(part("w1", "l"), ["lang", "w1"]).join(part("w2", "r"), ["lang", "w2"])
    pairs = pairs.withColumn("score", _score("a", "l", "r"))
    # A pair inside a frequent triple that has half its occurrences is no phrase by itself.
    inside = triples.select("lang", F.explode(F.array(F.struct("w1", "w2"), F.struct(F.col("w2").alias("w1"), F.col("w3").alias("w2")))).alias("x"), "a")
    inside = inside.groupBy("lang", F.col("x.w1").alias("w1"), F.col("x.w2").alias("w2")).agg(F.max("a").alias("longer"))
    pairs = pairs.join(inside, ["lang", "w1", "w2"], "left").where(
        F.col("longer").isNull() | (100 * F.col("longer") < ABSORBED_PERCENT * F.col("a"))
    )
    triples = (
        triples.join(part("w1", "l1"), ["lang", "w1"]).join(part("w2", "w3", "r1"), ["lang", "w2", "w3"])
        .join(part("w1", "w2", "l2"), ["lang", "w1", "w2"]).join(part("w3", "r2"), ["lang", "w3"])
        .withColumn("s1", _score("a", "l1", "r1"))
        .withColumn("s2", _score("a", "l2", "r2"))
    )
    first = F.col("s1") <= F.col("s2")
    either = lambda x, y, name: F.when(first, F.col(x)).otherwise(F.col(y)).alias(name)
    found = pairs.select("lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), "a", "l", "r", "score").unionAll(
        triples.select(
            "lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), "a",
            either("l1", "l2", "l"), either("r1", "r2", "r"), either("s1", "s2", "score"),
        )
    )
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    salt = F.pmod(F.xxhash64("phrase"), F.lit(SALTS)).alias("salt")
    best = found.select("*", salt).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order)))
    best = best.where(F.col("rank") <= ranked)
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("bigint"))
    totals = counts.where("w1 is null").select("lang", F.col("f").alias("n"))
    return best.where(F.col("rank") <= ranked).join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
