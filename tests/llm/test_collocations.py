from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerline.llm import collocations
from ledgerline.llm.queries import QUERIES

from . import brute
from .conftest import EDGE_TEXTS, LONG, SF_DIR, rows

COLUMNS = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def counted(docs) -> dict[str, Counter]:
    """Counts of all phrases of up to three words (tuples) by language; the empty one counts words."""
    out: dict[str, Counter] = {}
    for lang, text in docs:
        own = out.setdefault("und" if lang is None else lang, Counter())
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", brute.lower(text or "")):
            found = re.findall("[^ \t]+", piece)
            own[()] += len(found)
            for k in (1, 2, 3):
                own.update(tuple(found[i : i + k]) for i in range(len(found) - k + 1))
    return out


def brute_force(docs, ranked=2000, least=10) -> list[tuple]:
    out = []
    for lang, f in counted(docs).items():
        found = []
        for phrase, a in f.items():
            if len(phrase) < 2 or a < least:
                continue
            if any(
                len(longer) == 3 and phrase in (longer[:2], longer[1:]) and n >= least and 100 * n >= 50 * a
                for longer, n in (f.items() if len(phrase) == 2 else ())
            ):
                continue
            cuts = [(1_000_000 * a * a // (f[phrase[:k]] * f[phrase[k:]]), k) for k in range(1, len(phrase))]
            score, k = min(cuts)
            found.append((-score, -a, " ".join(phrase).encode(), f[phrase[:k]], f[phrase[k:]]))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(found)[:ranked], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, f[()], -score))
    return sorted(out, key=repr)


def frame(spark, docs):
    return spark.createDataFrame(docs, "lang string, text string").repartition(3)


def test_query_on_the_smallest_tables(spark, tables):
    docs = [r.asDict() for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("lang", "text").collect()]
    want = brute_force([(d["lang"], d["text"]) for d in docs])
    found = rows(QUERIES["op12_phrase_collocations"](spark, SF_DIR), *COLUMNS)
    assert len(found) > 50
    assert found == want


CASES = [
    ("en", "Red fox, red fox; red fox jumps! a red\nfox. RED fox"),
    ("en", "a b c a b c a b c. a b d a b d"),
    ("en", "x x x x x x x x"),
    (None, "red fox red fox"),
    ("und", "red fox red fox red fox"),
    ("", "red fox " * 9),
    ("de", "Übung macht den Übung macht den Übung"),
    ("de", None),
    (None, None),
    ("fr", "\x0b\x0c\r\n \t"),
    ("fr", "a\tb a b a\x0bb a  b"),
    ("es", "\x00\x1f \x1f\x00 \x00\x1f"),
]


@pytest.mark.parametrize("least", [1, 2, 3])
def test_cases_against_brute_force(spark, least):
    found = collocations.collocations(frame(spark, CASES), least=least)
    assert rows(found, *COLUMNS) == brute_force(CASES, least=least)


def test_small_tries_spill_and_burst(spark):
    """Tries of a few phrases, words and containers give the same counts."""
    docs = [("en" if i % 3 else None, " ".join(f"w{(i * j) % 23}" for j in range(60))) for i in range(40)]
    found = collocations.collocations(frame(spark, docs), least=2, most=50, burst=8, most_words=40)
    assert rows(found, *COLUMNS) == brute_force(docs, least=2)


def test_ranks_are_cut_with_ties_in_byte_order(spark):
    docs = [("en", ". ".join(f"{a}{i} {a}{i}x" for i in range(9) for a in "zaéÿ"))] * 10
    found = collocations.collocations(frame(spark, docs), ranked=7)
    assert rows(found, *COLUMNS) == brute_force(docs, ranked=7)


def test_counts_beyond_64_bits(spark):
    a = 3_000_000_000_000
    table = spark.createDataFrame([(a, a + 1, a + 2)], "a bigint, l bigint, r bigint")
    want = 1_000_000 * a * a // ((a + 1) * (a + 2))
    assert table.select(collocations._score("a", "l", "r").alias("s")).first().s == want


def test_special_cases_and_clashing_columns(spark, edge_documents):
    docs = edge_documents.selectExpr("*", "bucket AS lang", "1 AS w1", "2 AS f", "3 AS rank", "'k' AS phrase")
    found = collocations.collocations(docs)
    assert rows(found, *COLUMNS) == brute_force([("y", t) for _, t in EDGE_TEXTS])


def test_empty_table(spark):
    assert collocations.collocations(spark.createDataFrame([], "lang string, text string")).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.sampled_from([None, "en", "de"]), st.text("ab,. \t\nÄ", max_size=40)), max_size=12))
def test_counter_counts_all_phrases(docs):
    counter, found = collocations.Counter(most=20, burst=4, most_words=6), Counter()
    batches = []
    for i in range(0, len(docs), 4):
        own = docs[i : i + 4]
        part = pa.RecordBatch.from_arrays(
            [pa.array([x[0] for x in own], pa.string()), pa.array([x[1] for x in own], pa.string())], ["lang", "text"]
        )
        batches += counter.add(part)
    batches += counter.finish()
    for batch in batches:
        lines = list(zip(*(c.to_pylist() for c in batch.columns)))
        phrases = [(x[0], *(w or "" for w in x[1:4])) for x in lines]
        assert phrases == sorted(phrases)  # every run is sorted
        for lang, a, b, c, f in lines:
            found[(lang, *(w for w in (a, b, c) if w is not None))] += f
    want = Counter({(lang, *p): n for lang, own in counted(docs).items() for p, n in own.items() if len(p) < 3 and n})
    assert found == want


def test_containers_keep_prefixes_whole():
    trie, rng = collocations.HatTrie(burst=64), np.random.default_rng(3)
    keys = np.unique((rng.integers(1, 40, 4000) << 42) | (rng.integers(0, 40, 4000) << 21))
    for part in np.array_split(keys, 7):
        trie.add(part, np.ones(len(part), np.int64))
    lows = [c.low for c in trie.containers]
    assert lows == sorted(lows) and all(low % (1 << 21) == 0 for low in lows)
    assert max(c.n for c in trie.containers) <= 64
    found = np.concatenate([c.sorted()[0] for c in trie.containers])
    assert np.array_equal(found, keys)


def test_long_text(spark):
    assert collocations.collocations(frame(spark, [("en", LONG)] * 10)).count() > 0


def test_runs_hold_a_phrase_in_one_column(spark):
    """Every phrase of every task is written, moved and grouped: one text is half the row of three."""
    runs = collocations._runs(frame(spark, [("en", "a b. \x00 a"), (None, "é")]))
    assert runs.columns == ["lang", "phrase", "f"]
    merged = collocations._merged(runs, least=1)
    assert rows(merged, "lang", "w1", "w2", "w3", "f") == sorted(
        [("en", None, None, None, 4), ("en", "a", None, None, 2), ("en", "b", None, None, 1), ("en", "a", "b", None, 1),
         ("en", "\x00", None, None, 1), ("en", "\x00", "a", None, 1), ("und", None, None, None, 1), ("und", "é", None, None, 1)],
        key=repr,
    )
