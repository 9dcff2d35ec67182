from __future__ import annotations

import random

from . import brute
import numpy as np
import pytest
from .conftest import EDGE_TEXTS, rows
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerline.llm import common
from ledgerline.llm import signature_trees as trees
from ledgerline.llm.common import components


def near_copies(n: int, words: int, edits: int, seed: int) -> list[str]:
    rng = random.Random(seed)
    base = [f"w{rng.randrange(10_000)}" for _ in range(words)]
    out = []
    for _ in range(n):
        own = list(base)
        for _ in range(rng.randrange(edits + 1)):
            own[rng.randrange(words)] = f"x{rng.randrange(10_000)}"
        out.append(" ".join(own))
    return out


@given(st.integers(0, 10_000), st.integers(4, 400), st.integers(0, 80), st.sampled_from([90, 80]))
@settings(max_examples=300, deadline=None)
def test_linked_sets_share_parts(seed, n, cut, percent):
    """Any two sets that link have as many parts in common, in a common cutting, as each of them needs."""
    rng = np.random.default_rng(seed)
    a = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64) * np.uint64(2))
    lost = min(cut, len(a) - 1)
    new = rng.integers(0, 1 << 63, rng.integers(0, 20)).astype(np.uint64) * np.uint64(2)
    b = np.unique(np.concatenate((rng.permutation(a)[lost:], new)))
    both = len(np.intersect1d(a, b))
    if 100 * both >= percent * (len(a) + len(b) - both) and not np.array_equal(a, b):
        (x, least_x), (y, least_y) = trees._parts(a, percent), trees._parts(b, percent)
        odd = np.intersect1d(x, y) & np.uint64(1)
        common = (int((odd == 0).sum()), int(odd.sum()))
        assert any(min(own) > 0 and n >= max(own) for n, *own in zip(common, least_x, least_y))


@given(st.integers(0, 10_000), st.booleans())
@settings(max_examples=30, deadline=None)
def test_tree_walk_finds_all_links(seed, two_sides):
    texts = near_copies(25, 40, 4, seed) + near_copies(15, 200, 30, seed + 1)
    sets = [np.unique(np.array([hash(s) & (1 << 63) - 1 for s in brute.shingles(t)], np.uint64)) for t in texts]
    side = np.array([i % 2 if two_sides else 0 for i in range(len(sets))])
    up = list(range(len(sets)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, j in trees.walk(sets, side, 90):
        up[root(i)] = root(j)
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            both = len(np.intersect1d(a, b))
            links = 100 * both >= 90 * (len(a) + len(b) - both)
            if links and (not two_sides or side[i] != side[j]):
                assert root(i) == root(j)


def compare(spark, docs):
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(5)
    found = trees.near_duplicates(df).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == brute.near(docs)
    assert len(found) == len(docs)


@pytest.mark.parametrize("small_nodes", [False, True])
def test_groups_of_near_copies(spark, monkeypatch, small_nodes):
    """A large group below one root, also when its tree has many nodes."""
    if small_nodes:
        monkeypatch.setattr(trees, "NODE_SHINGLES", 500)
        monkeypatch.setattr(trees, "NODES_PER_ROOT", 1000)
    texts = near_copies(120, 60, 3, 1) + near_copies(40, 300, 12, 2) + near_copies(30, 15, 1, 3) + ["a b", "a b", "c"] * 3
    random.Random(4).shuffle(texts)
    compare(spark, list(enumerate(texts)))


def test_common_passage_links_nothing(spark):
    passage = " ".join(f"p{i}" for i in range(60))
    rng = random.Random(5)
    texts = [passage + " " + " ".join(f"z{rng.randrange(10**6)}" for _ in range(30)) for _ in range(60)]
    compare(spark, list(enumerate(texts)))


def test_special_cases(spark, edge_documents, no_documents):
    found = rows(trees.near_duplicates(edge_documents))
    assert len(found) == len(EDGE_TEXTS)
    known = {r[0]: r[1:] for r in found if r[0] is not None}
    want = brute.near([(i, t) for i, t in dict(x for x in EDGE_TEXTS if x[0] is not None).items()])
    assert known == want
    assert [r[2] for r in found if r[0] is None] == [None, None]
    assert rows(trees.near_duplicates(no_documents)) == []


def test_one_of_each_group(spark, edge_documents, no_documents):
    found = trees.one_of_each(edge_documents)
    assert found.dtypes == edge_documents.dtypes
    assert rows(found, "doc_id") == [(1,), (10,), (11,), (12,), (3,), (4,), (5,), (6,), (7,), (8,), (9,), (None,), (None,)]
    assert rows(trees.one_of_each(no_documents)) == []


def test_rows_that_repeat_an_id_with_other_texts_stay(spark):
    """Two feeds numbered alike: only texts linked with each other give way to one."""
    texts = [" ".join(f"w{k}x{i}" for i in range(60)) for k in range(5)]
    near = texts[2].replace("w2x30", "other")
    data = [(1, texts[0], 0), (1, texts[1], 1), (2, texts[2], 2), (1, near, 3), (1, texts[0], 4), (3, texts[4], 5), (None, texts[0], 6), (2, "", 7)]
    docs = spark.createDataFrame(data, "doc_id bigint, text string, extra int").repartition(3)
    found = rows(trees.one_of_each(docs), "doc_id", "text")
    want = [(1, texts[0]), (1, texts[1]), (1, near), (3, texts[4]), (None, texts[0]), (2, "")]
    assert found == sorted(want, key=repr)
    assert trees.one_of_each(docs).dtypes == docs.dtypes


def test_a_run_leaves_only_what_its_result_reads(spark):
    import os

    root = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(root)) if os.path.isdir(root) else set()
    docs = spark.createDataFrame(list(enumerate(near_copies(20, 60, 2, 5))), "doc_id bigint, text string")
    trees.near_duplicates(docs).count()
    left = {x.rsplit("-", 1)[0] for x in set(os.listdir(root)) - before}
    assert left == {"shingles", "classes"}, left


def test_more_ids_than_are_broadcast(spark, monkeypatch):
    """Beyond the bounds joins take the place of the filter and the broadcast; the rows are the same."""
    monkeypatch.setattr(common, "FILTER_IDS", 0)
    monkeypatch.setattr(common, "BROADCAST_IDS", 0)
    docs = list(enumerate(near_copies(30, 60, 3, 7) + ["a b c d", "a b c d"]))
    compare(spark, docs)
    kept = trees.one_of_each(spark.createDataFrame(docs, "doc_id bigint, text string"))
    assert rows(kept, "doc_id") == sorted({(root,) for _, root in brute.near(docs, 5, 80).values()}, key=repr)


def test_id_filter_loses_no_id(spark):
    ids = [(i * 7919 - 10**9,) for i in range(5000)] + [(2**63 - 1,), (-(2**63),)]
    found = common.id_filter(spark.createDataFrame(ids, "doc_id bigint")).value
    assert found.may_hold(np.array([i for i, in ids], np.int64)).all()
    assert found.may_hold(np.arange(10**12, 10**12 + 20_000)).mean() < 0.05


def test_components_of_a_chain_and_a_hub(spark):
    links = [(i, i + 1) for i in range(100, 140)] + [(7, 1000 + i) for i in range(50)] + [(3, 3)]
    found = rows(components(spark.createDataFrame(links, "a bigint, b bigint"), "test"))
    assert found == sorted([(i, 100) for i in range(100, 141)] + [(7, 7)] + [(1000 + i, 7) for i in range(50)], key=repr)
