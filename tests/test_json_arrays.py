from __future__ import annotations

import json
import os
import uuid

import pytest
from hypothesis import given, settings, strategies as st

from ledgerline import schemas
from ledgerline.operators.quality import CORRUPT
from ledgerline.sources import json as source
from ledgerline.sources.json_arrays import pieces


@pytest.fixture
def small_ranges(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64")
    spark.conf.set("spark.sql.files.openCostInBytes", "8")
    yield
    for k, value in before.items():
        spark.conf.set(k, value)


def write(folder, *documents: str) -> str:
    path = f"{folder}/{uuid.uuid4().hex}"
    os.makedirs(path)
    for i, text in enumerate(documents):
        with open(f"{path}/{i}.json", "w", newline="") as file:
            file.write(text)
    return path


def read(spark, path: str) -> list[dict]:
    """Sound records, without fields that are NULL."""
    rows = source.read_loans(spark, path, multi_line=True).where(f"{CORRUPT} is null").collect()
    return in_order({k: v for k, v in r.asDict().items() if v is not None} for r in rows)


def in_order(records) -> list[dict]:
    return sorted(records, key=lambda r: sorted(r.items()))


def damaged(spark, path: str) -> list[str]:
    return [r[CORRUPT] for r in source.read_loans(spark, path, multi_line=True).where(f"{CORRUPT} is not null").collect()]


def test_one_large_document_is_read_by_many_tasks(spark, small_ranges, tmp_path):
    loans = [{"Application_ID": f"LP{i:06}", "Gender": "Male" if i % 2 else "Female"} for i in range(200)]
    path = write(tmp_path, json.dumps(loans, indent=2))
    assert pieces(spark, path).rdd.getNumPartitions() > 50
    assert read(spark, path) == in_order(loans)


def test_a_record_across_many_ranges(spark, small_ranges, tmp_path):
    loans = [{"Application_ID": "a"}, {"Application_ID": "b", "Income": 'x}" ,{[' * 60, "Gender": "\\" * 99}, {"Application_ID": "c"}]
    path = write(tmp_path, json.dumps(loans, indent=1))
    assert pieces(spark, path).where("value like '%x%'").select("first_byte").distinct().count() > 3
    assert read(spark, path) == in_order(loans)


TEXT = st.text('ab"\\{}[],:\n é/', max_size=25)
LOAN = st.fixed_dictionaries({"Application_ID": TEXT}, optional={"Gender": TEXT, "Income": TEXT, "Education": TEXT})


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.lists(LOAN, max_size=6), st.sampled_from([None, 1, 4]), st.booleans()), min_size=1, max_size=4))
def test_any_strings_at_the_cuts(spark, tmp_path_factory, documents):
    """Quotes, escapes and braces wherever a byte range begins; several documents, on one line or many."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "23")
    spark.conf.set("spark.sql.files.openCostInBytes", "8")
    try:
        texts = [json.dumps(loans, indent=indent, ensure_ascii=escaped) for loans, indent, escaped in documents]
        path = write(tmp_path_factory.mktemp("documents"), *texts)
        assert read(spark, path) == in_order(x for loans, *_ in documents for x in loans)
        assert damaged(spark, path) == []
    finally:
        for k, value in before.items():
            spark.conf.set(k, value)


def test_inner_objects_do_not_end_a_record(spark, small_ranges, tmp_path):
    text = '[{"Application_ID": "a", "more": {"x": {"y": [{}, {"z": "}"}]}}, "Gender": "Male"}, {"Application_ID": "b"}]'
    assert read(spark, write(tmp_path, text)) == [{"Application_ID": "a", "Gender": "Male"}, {"Application_ID": "b"}]


def test_a_single_object_empty_arrays_and_empty_files(spark, tmp_path):
    path = write(tmp_path, '{"Application_ID": "a",\n "x": {}}\n', "[]", "", " \n[ ]\n", '\ufeff[\n{"Application_ID": "b"}\n]', '{"Application_ID": "c"}')
    assert read(spark, path) == [{"Application_ID": x} for x in "abc"]
    assert damaged(spark, path) == []


@pytest.mark.parametrize("text", ['[{"Application_ID": "a"}, {"Application_ID": "b"', '[{"Application_ID": "a"}, {"Application_ID": "b",\n'])
def test_a_document_cut_short_loses_its_last_record_only(spark, small_ranges, tmp_path, text):
    path = write(tmp_path, text)
    assert read(spark, path) == [{"Application_ID": "a"}]
    assert len(damaged(spark, path)) == 1


def test_a_damaged_record_does_not_spoil_the_others(spark, small_ranges, tmp_path):
    text = '[{"Application_ID": "a"}, {"Application_ID": oops}, {"Application_ID": "c"}, 7, {"Application_ID": "d"}, {"Application_ID": "e"}]'
    path = write(tmp_path, text)
    assert read(spark, path) == [{"Application_ID": x} for x in "ace"]
    assert len(damaged(spark, path)) == 2


def test_schema_and_plan(spark, tmp_path):
    found = source.read_loans(spark, write(tmp_path, "[]"), multi_line=True)
    assert found.columns == [*schemas.LOAN_FEED.names, CORRUPT]
    assert found.count() == 0
    text = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Arrow" not in text
