from __future__ import annotations

import hashlib
import random

import pytest
from .conftest import EDGE_TEXTS, rows
from pyspark.sql import functions as F

from ledgerline.llm import sharding


def grown(keys_bytes, limit):
    """The shards by splitting buckets one bit at a time."""
    bits = [(f"{int(hashlib.md5(str(k).encode()).hexdigest()[:15], 16):060b}", n) for k, n in keys_bytes]
    done, work = [], [("", bits)]
    while work:
        name, own = work.pop()
        if sum(n for _, n in own) <= limit or len(own) == 1 or len({b for b, _ in own}) == 1:
            done.append((name, len(own), sum(n for _, n in own)))
        else:
            for bit in "01":
                part = [(b, n) for b, n in own if b.startswith(name + bit)]
                if part:
                    work.append((name + bit, part))
    return sorted(done)


@pytest.mark.parametrize("limit", [100, 1000, 50_000, 10**9])
@pytest.mark.parametrize("round_bits", [1, 8])
def test_directory(spark, monkeypatch, limit, round_bits):
    monkeypatch.setattr(sharding, "ROUND_BITS", round_bits)
    rng = random.Random(2)
    data = [(i, "x" * rng.choice([0, 10, 90, 400, 3000])) for i in range(300)]
    found = sharding.shard(spark.createDataFrame(data, "doc_id bigint, text string").repartition(3), limit)
    shards = rows(found.groupBy("shard").agg(F.count("*"), F.sum("bytes")))
    assert shards == grown([(i, len(t)) for i, t in data], limit)
    assert rows(found, "doc_id", "bytes") == sorted(((i, len(t)) for i, t in data), key=repr)


def test_hot_key_is_split(spark):
    data = [(i, "x" * 50, "hot" if i % 3 else f"k{i}") for i in range(600)] + [(1000, "y" * 5000, "hot")]
    docs = spark.createDataFrame(data, "doc_id bigint, text string, source string").repartition(4)
    found = sharding.shard(docs, 2000, key="source").cache()
    sums = found.groupBy("shard").agg(F.sum("bytes").alias("sum"), F.count("*").alias("n")).collect()
    assert all(r["sum"] <= 2000 or r.n == 1 for r in sums)
    assert found.count() == 601 and found.select("doc_id").distinct().count() == 601
    assert all(r.shard_bytes == s for r, s in ((r, {x.shard: x["sum"] for x in sums}[r.shard]) for r in found.collect()))


def test_special_cases(spark, edge_documents, no_documents):
    found = sharding.shard(edge_documents, 1 << 14)
    want = [(i, len((t or "").encode())) for i, t in EDGE_TEXTS]
    assert rows(found, "doc_id", "bytes") == sorted(want, key=repr)
    assert rows(sharding.shard(no_documents)) == []
