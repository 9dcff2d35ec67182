from __future__ import annotations

import hashlib
import zlib

import pytest

from ledgerline.llm import merkle
from ledgerline.llm.queries import QUERIES

from .conftest import SF_DIR, rows

COLUMNS = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string"


def h(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row) -> str:
    return h("".join("-" if x is None else f"{len(str(x).encode())}:{x}" for x in row))


def levels_of(nodes: list[str]) -> list[list[str]]:
    """The nodes of every level, the lowest first."""
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h("".join(out[-1][i : i + 16])) for i in range(0, len(out[-1]), 16)])
    return out


def siblings(levels: list[list[str]], place: int) -> list[tuple[list[str], list[str]]]:
    """For each level below the top the siblings left and right of the node above the leaf ``place``."""
    out = []
    for level in levels[:-1]:
        first = place - place % 16
        out.append((level[first:place], level[place + 1 : first + 16]))
        place //= 16
    return out


def brute_force(documents) -> list[tuple]:
    """Rows of (doc_id, source, lang, n_chars, text), tree by tree in lists."""
    key = lambda x: (x is not None, x.encode() if isinstance(x, str) else x or 0)
    trees = {}
    for row in documents:
        trees.setdefault(row[1], []).append(row)
    sources = sorted(trees, key=key)
    own = {}
    for source in sources:
        trees[source].sort(key=lambda r: (key(r[0]), leaf(r)))
        own[source] = levels_of([leaf(r) for r in trees[source]])
    top = levels_of([own[s][-1][0] for s in sources]) if sources else []
    out = []
    for number, source in enumerate(sources):
        for place, row in enumerate(trees[source]):
            path = siblings(own[source], place) + siblings(top, number)
            changed = row
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0 and row[4] is not None:
                changed = (*row[:4], row[4].translate({c: c + 32 for c in range(65, 91)}))
            folded = leaf(changed)
            for left, right in path:
                folded = h("".join([*left, folded, *right]))
            proof = h("".join("".join([*left, *right]) for left, right in path))
            root = top[-1][0]
            out.append((row[0], leaf(row), own[source][-1][0], root, proof, folded, folded == root))
    return sorted(out, key=repr)


def test_query_on_the_smallest_tables(spark, tables):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "source", "lang", "n_chars", "text")
    want = brute_force([tuple(r) for r in docs.collect()])
    found = rows(QUERIES["op11_merkle_manifest"](spark, SF_DIR), *COLUMNS)
    assert found == want
    assert {r[-1] for r in found} == {True, False}


@pytest.mark.parametrize("n", [1, 2, 16, 17, 256, 257, 300])
def test_sizes_of_one_source(spark, n):
    docs = [(i, "s", None, i, f"Text {i}") for i in range(n)]
    found = merkle.verify(spark.createDataFrame(docs, SCHEMA).repartition(3))
    assert rows(found, *COLUMNS) == brute_force(docs)


def test_nulls_repeated_rows_and_many_sources(spark):
    docs = [(i, f"ü{i % 40}", "en", i, "A" * i) for i in range(120)]
    docs += [(None, None, None, None, None)] * 20 + [(7, None, "de", 1, "Same")] * 40 + [(7, "hot", "", 0, "")] * 3
    docs += [(i, "hot", "fr", -i, "x\u0000Y") for i in range(700)]
    found = merkle.verify(spark.createDataFrame(docs, SCHEMA).repartition(5))
    assert rows(found, *COLUMNS) == brute_force(docs)


def test_special_cases_and_clashing_columns(spark, edge_documents):
    docs = edge_documents.selectExpr("*", "'tree' AS source", "bucket AS lang", "1 AS place", "2 AS level", "n AS hash", "3 AS up")
    plain = [tuple(r) for r in docs.select("doc_id", "source", "lang", "n_chars", "text").collect()]
    assert rows(merkle.verify(docs), *COLUMNS) == brute_force(plain)


def test_empty_table(spark):
    assert merkle.verify(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("limit, strategy", [(0, "merge"), (1 << 20, "broadcast")])
def test_paths_are_not_broadcast_by_the_size_of_their_files(spark, monkeypatch, limit, strategy):
    """Files hold repeated hashes packed, so that Spark takes long paths for short ones."""
    from ledgerline.llm import common

    docs = [(i, "big", "en", i, f"Text {i}") for i in range(5000)] + [(i, f"s{i % 300}", "de", i, "x") for i in range(1000)]
    real, plans = merkle.materialize, []

    def noted(df, purpose):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        if purpose == "merkle-jump" and "Join" in plan:
            plans.append(plan)
        return real(df, purpose)

    monkeypatch.setattr(merkle, "materialize", noted)
    monkeypatch.setattr(common, "BROADCAST_BYTES", limit, raising=False)
    found = merkle.verify(spark.createDataFrame(docs, SCHEMA).repartition(3))
    assert rows(found, *COLUMNS) == brute_force(docs)
    assert len(plans) >= 4 and all(f"strategy={strategy}" in x for x in plans)
    if not limit:
        found.collect()
        assert "BroadcastHashJoin" not in found._jdf.queryExecution().executedPlan().toString()


def test_a_turn_joins_only_nodes_that_others_point_to(spark, monkeypatch):
    docs = [(i, "big", "en", i, f"Text {i}") for i in range(5000)]
    real, n = merkle.dealt, []
    monkeypatch.setattr(merkle, "dealt", lambda rows, size: n.append(rows.count() if "_path" in rows.columns else None) or real(rows, size))
    found = merkle.verify(spark.createDataFrame(docs, SCHEMA).repartition(3))
    assert [x for x in n if x is not None] == [23, 3]  # of 336 inner nodes: 313, 20, 2 and 1 a level
    assert rows(found, *COLUMNS) == brute_force(docs)


def test_a_run_leaves_only_what_its_result_reads(spark, tmp_path):
    import glob
    import os

    root = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(root)) if os.path.isdir(root) else set()
    docs = spark.createDataFrame([(i, f"s{i % 3}", "en", i, "T") for i in range(600)], SCHEMA)
    assert merkle.verify(docs).count() == 600
    left = sorted(x.rsplit("-", 1)[0] for x in set(os.listdir(root)) - before if glob.glob(f"{root}/{x}/*.parquet"))
    assert left == ["merkle-paths", "merkle-placed", "merkle-subroots"]
