from __future__ import annotations

from . import brute
import pytest
from .conftest import LONG, PROSE, SF_DIR, rows
from tokenizers import Tokenizer

import corpus_pipeline
from ledgerline.llm.tokens import public_tokenizer


def test_stages_on_the_smallest_tables(spark, tables):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, kept, texts = docs.columns, [], dict((r[0], r[1]) for r in tables["documents"])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF_DIR).cache()
        assert docs.columns == columns
        kept.append({r.doc_id: r.text for r in docs.select("doc_id", "text").collect()})
    cleaned, unique, decontaminated, masked = kept
    assert all(not brute.quality(texts[i])["base_failed"] for i in cleaned)
    # Of every group one stays, and no two that stay are linked.
    groups = brute.near(list(cleaned.items()), 5, 80)
    assert set(unique) == {root for _, root in groups.values()}
    bad = {r[0] for r in brute.overlaps(list(unique.items()), tables["benchmark"]) if r[5]}
    assert set(decontaminated) == set(unique) - bad
    assert all(sum(brute.personal(t)[:4]) == 0 for t in masked.values())
    assert all(masked[i] == t for i, t in decontaminated.items() if not sum(brute.personal(t)[:4]))
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).cache()
    assert {r.doc_id for r in packed.collect()} == set(masked)
    assert brute.gapless(rows(packed, "sequence_id", "offset", "length"))


def test_special_cases(spark, edge_documents, tmp_path):
    edge_documents.write.parquet(f"{tmp_path}/documents.parquet")
    items = spark.createDataFrame([(1, PROSE.upper())], "item_id bigint, text string")
    items.write.parquet(f"{tmp_path}/benchmark.parquet")
    # Prose of the benchmark goes, short and empty texts are junk, one of two equal rows stays.
    found = rows(corpus_pipeline.run(spark, str(tmp_path)), "doc_id", "piece", "start", "length", "ids_crc32")
    assert found == sorted(brute.pieces([(8, LONG)], Tokenizer.from_file(public_tokenizer())), key=repr)


def test_empty_tables(spark, no_documents, tmp_path):
    no_documents.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


@pytest.mark.parametrize("stage", range(5))
def test_every_stage_takes_nulls_and_empty_tables(spark, edge_documents, no_documents, stage):
    function = corpus_pipeline.STAGES[stage][1]
    function(spark, edge_documents, SF_DIR).count()
    assert function(spark, no_documents, SF_DIR).count() == 0
