from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from ledgerline.llm import order_minhash as omh
from ledgerline.llm.queries import QUERIES

from .conftest import LONG, SF_DIR, rows

SYMBOLS = re.compile(r"[^\x20\x09-\x0D]{1,16}")
M = (1 << 64) - 1


def rotl(x, r):
    return ((x << r) | (x >> (64 - r))) & M


P1, P2, P3, P4, P5 = (
    0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5,
)


def mix(h):
    h = (h ^ (h >> 33)) * P2 & M
    h = (h ^ (h >> 29)) * P3 & M
    return h ^ (h >> 32)


def hash_long(value, seed):
    """XXH64 of eight bytes, as Spark hashes a bigint."""
    h = (seed + P5 + 8) & M
    h ^= rotl(value * P2 & M, 31) * P1 & M
    return mix((rotl(h, 27) * P1 + P4) & M)


def hash_int(value, seed):
    h = (seed + P5 + 4) & M
    h ^= (value & 0xFFFFFFFF) * P1 & M
    return mix((rotl(h, 23) * P2 + P3) & M)


def hash_text(text, seed):
    import xxhash

    return xxhash.xxh64_intdigest(text.encode(), seed)


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def fingerprint(text) -> str:
    """Order MinHash of one text, k-mer by k-mer."""
    symbols = SYMBOLS.findall(text or "")
    if not symbols:
        return ""
    kmers = []
    for i in range(max(1, len(symbols) - omh.KMER + 1)):
        h = 42
        for symbol in symbols[i : i + omh.KMER]:
            h = hash_text(symbol, h)
        kmers.append(h)
    low = (1 << len(bin(len(symbols) + 1)[2:])) - 1
    seen, hashes = Counter(), []
    for place, kmer in enumerate(kmers):
        h = hash_int(seen[kmer], hash_long(kmer, 42))
        seen[kmer] += 1
        hashes.append(((signed(h) & ~low) | (place + 1), place))
    hashes.sort()
    out = []
    for j in range(omh.SLOTS):
        begin = (j << (64 - omh.SLOT_BITS)) - (1 << 63)
        start = sum(h < begin for h, _ in hashes)
        places = sorted(hashes[(start + t) % len(hashes)][1] for t in range(omh.TUPLE))
        h = 42
        for p in places:
            h = hash_long(kmers[p], h)
        out.append(f"{h:016x}"[-omh.HASH_CHARS :])
    return "".join(out)


def likeness(a: str, b: str) -> float:
    if not a or not b:
        return float(a == b)
    w = omh.HASH_CHARS
    return sum(a[i : i + w] == b[i : i + w] for i in range(0, len(a), w)) / omh.SLOTS


def brute_force(docs) -> list[tuple]:
    """``docs`` are (doc_id, text) with different ids."""
    ring = sorted(((i, t or "") for i, t in docs), key=lambda x: (x[0] is None, -(x[0] or 0)))
    out = []
    for k, (i, text) in enumerate(ring):
        after = ring[(k + 1) % len(ring)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        own, theirs, following = fingerprint(text), fingerprint(edited), fingerprint(after)
        digest = hashlib.sha256(edited.encode()).hexdigest()
        out.append((i, len(text), digest, own, theirs, likeness(own, theirs), likeness(own, following)))
    return sorted(out, key=repr)


def frame(spark, docs):
    return spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)


def prints(spark, texts) -> list[str]:
    rows_ = omh.with_fingerprint(frame(spark, list(enumerate(texts))), "text", "p").select("doc_id", "p").collect()
    return [p for _, p in sorted((tuple(r) for r in rows_))]


def test_query_on_the_smallest_tables(spark, tables):
    want = brute_force([(r[0], r[1]) for r in tables["documents"]])
    assert rows(QUERIES["op13_order_minhash"](spark, SF_DIR)) == want


CASES = [
    (1, "one"), (2, "two words"), (3, None), (4, ""), (5, " \t\r\n\x0b"), (6, "a" * 500), (7, "same line here\n" * 60),
    (8, "Zażółć gęślą jaźń \U0001f600 naïve café " * 9), (9, "x " * 999), (10, "one two three"), (11, "a b a b a b c"),
    (None, "no id at all, but a text"), (-3, "below zero stands this one"), (10**15, "far up"),
]


def test_cases_against_brute_force(spark):
    assert rows(omh.edited(frame(spark, CASES))) == brute_force(CASES)


def test_one_document_follows_itself(spark):
    assert rows(omh.edited(frame(spark, [(1, "alone in the world")]))) == brute_force([(1, "alone in the world")])


def test_empty_table(spark):
    assert omh.edited(frame(spark, [])).count() == 0


def test_repeated_ids_and_rows(spark):
    """Rows equal in id and text are one document; equal ids with other texts follow each other by hash."""
    docs = [(1, "first text of all"), (2, "second text"), (2, "another text with that id"), (2, "second text"), (None, None), (None, None)]
    found = rows(omh.edited(frame(spark, docs)))
    assert len(found) == len(docs)
    assert len({r for r in found if r[1] == len("second text")}) == 1
    assert len(set(found)) == 4


def test_special_cases_and_clashing_columns(spark, edge_documents):
    docs = edge_documents.selectExpr("*", "1 AS _n", "2 AS fingerprint", "3 AS kept", "4 AS place")
    found = omh.edited(docs)
    assert found.count() == edge_documents.count()
    assert found.where("near_edited NOT BETWEEN 0 AND 1 OR near_next NOT BETWEEN 0 AND 1").isEmpty()
    assert found.where("edited_sha256 IS NULL OR fingerprint IS NULL").isEmpty()


def distance(a: list, b: list) -> int:
    line = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, line[0] = line[0], i
        for j, y in enumerate(b, 1):
            last, line[j] = line[j], min(line[j] + 1, line[j - 1] + 1, last + (x != y))
    return line[-1]


def test_likeness_falls_with_the_edit_distance(spark):
    rng = random.Random(5)
    base = [f"w{rng.randrange(400)}" for _ in range(300)]
    texts, far = [base], [0]
    for edits in (1, 4, 16, 64, 200):
        other = list(base)
        for _ in range(edits):
            other[rng.randrange(len(other))] = f"v{rng.randrange(9999)}"
        texts.append(other)
        far.append(distance(base, other))
    found = prints(spark, [" ".join(t) for t in texts])
    near = [likeness(found[0], p) for p in found]
    assert near[0] == 1 and near == sorted(near, reverse=True) and near[-1] < 0.2 < near[2]
    assert np.corrcoef(far, near)[0, 1] < -0.6


def test_order_counts_where_the_words_are_the_same(spark):
    """Blocks of a text in another order keep nearly all k-mers, but not the fingerprint."""
    rng = random.Random(8)
    words = [f"w{i}" for i in range(600)]
    blocks = [words[i : i + 30] for i in range(0, 600, 30)]
    moved = [w for b in rng.sample(blocks, len(blocks)) for w in b]
    a, b = prints(spark, [" ".join(words), " ".join(moved)])
    kmers = [{tuple(x[i : i + 3]) for i in range(len(x) - 2)} for x in (words, moved)]
    jaccard = len(kmers[0] & kmers[1]) / len(kmers[0] | kmers[1])
    assert jaccard > 0.8 and likeness(a, b) < 0.75 * jaccard


def test_repetitions_count(spark):
    a, b = prints(spark, ["again and " * 10, "again and " * 200])
    assert likeness(a, b) < 0.5


@pytest.mark.parametrize("text", [LONG, "lorem " * 100_000])
def test_long_texts_take_no_square_time(spark, text):
    assert prints(spark, [text, text + "x"])[0] == prints(spark, [text])[0]


def test_query_runs_no_python_and_shuffles_no_words(spark):
    plan = QUERIES["op13_order_minhash"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop", "Generate"))
