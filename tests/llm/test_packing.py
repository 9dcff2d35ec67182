from __future__ import annotations

import random
from collections import Counter

from . import brute
import pyarrow as pa
import pytest
from .conftest import EDGE_TEXTS, rows
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ledgerline.llm import packing, token_counts
from ledgerline.llm.tokens import WordEncoder, public_tokenizer


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizer())


@given(st.lists(st.text(max_size=60), max_size=6))
@settings(max_examples=150, deadline=None)
def test_words_encode_as_the_whole_text_does(tokenizer, texts):
    texts += ["a\x0b!b \x0c\x1c'S x<|endoftext|>y z é ́e", "İSTANBUL ΟΔΟΣ ﬁ ①", "a.b,c..d 3.14,5 x.'s A.É,e\u0301.", "<|ENDOFTEXT|> The.<|endoftext|>,a"]
    flat, starts = WordEncoder(public_tokenizer()).ids(pa.array(texts, pa.string()))
    for text, a, b in zip(texts, starts[:-1], starts[1:]):
        assert flat[a:b].tolist() == tokenizer.encode(text, add_special_tokens=False).ids
    assert WordEncoder(public_tokenizer()).lengths(pa.array(texts, pa.string())).tolist() == (starts[1:] - starts[:-1]).tolist()


def fewest(sizes: tuple[int, ...], capacity: int) -> int:
    """Fewest bins, by trying everything."""
    best = len(sizes)

    def place(i: int, rooms: list[int]) -> None:
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(sizes):
            best = len(rooms)
            return
        for j in range(len(rooms)):
            if rooms[j] >= sizes[i] and rooms[j] not in rooms[:j]:
                rooms[j] -= sizes[i]
                place(i + 1, rooms)
                rooms[j] += sizes[i]
        place(i + 1, [*rooms, capacity - sizes[i]])

    place(0, [])
    return best


@given(st.lists(st.integers(1, 20), min_size=1, max_size=9))
@settings(max_examples=200, deadline=None)
def test_reduction_keeps_an_optimum(sizes):
    sizes = sorted(sizes, reverse=True)
    fixed, rest = packing.reduce_by_dominance(dict(Counter(sizes)), 20)
    left = tuple(sorted((s for s, n in rest.items() for _ in range(n)), reverse=True))
    assert sum(n for _, n in fixed) + fewest(left, 20) == fewest(tuple(sizes), 20)


@given(st.dictionaries(st.integers(1, 64), st.integers(1, 500), max_size=30))
@settings(max_examples=100, deadline=None)
def test_plan_holds_every_piece_once(counts):
    patterns = packing.plan(counts, 64)
    back = Counter()
    for pattern, n in patterns:
        assert n > 0 and sum(size * copies for size, copies in pattern) <= 64
        for size, copies in pattern:
            back[size] += copies * n
    assert back == counts


@pytest.mark.parametrize("capacity", [16, 4096])
def test_pieces_and_places(spark, tokenizer, edge_documents, no_documents, capacity):
    found = packing.pack(edge_documents, public_tokenizer(), capacity, with_ids=True).cache()
    want = sorted(brute.pieces(EDGE_TEXTS, tokenizer, capacity), key=repr)
    assert rows(found, "doc_id", "piece", "start", "length", "ids_crc32") == want
    assert brute.gapless(rows(found, "sequence_id", "offset", "length"), capacity)
    whole = packing.sequences(found).collect()
    assert sum(len(r.ids) for r in whole) == sum(w[3] for w in want)
    assert rows(packing.pack(no_documents, public_tokenizer())) == []


def test_one_length_for_all(spark):
    docs = spark.createDataFrame([(i, "a b c") for i in range(1000)], "doc_id bigint, text string")
    found = packing.pack(docs, public_tokenizer(), capacity=16).cache()
    assert brute.gapless(rows(found, "sequence_id", "offset", "length"), 16)
    assert found.select("sequence_id").distinct().count() == 250


def test_token_counts(spark, tokenizer, edge_documents, no_documents):
    counts = token_counts.histogram(edge_documents, public_tokenizer())
    sizes = [len(tokenizer.encode(t or "", add_special_tokens=False).ids) for _, t in EDGE_TEXTS]
    assert dict(rows(counts)) == dict(Counter(sizes))
    sums = token_counts.suffix_sums(counts).cache()
    for limit in (0, 1, 7, 1000, 10**6):
        assert rows(token_counts.truncated_total(sums, limit)) == [(sum(min(x, limit) for x in sizes),)]
    for share in (0.1, 0.5, 0.9, 1.0):
        want = next(x for k, x in enumerate(sorted(sizes), 1) if k / len(sizes) >= share)
        assert rows(token_counts.quantile(sums, share)) == [(want,)]
    none = token_counts.suffix_sums(token_counts.histogram(no_documents, public_tokenizer()))
    assert rows(none) == [] and rows(token_counts.truncated_total(none, 5)) == [(0,)]
