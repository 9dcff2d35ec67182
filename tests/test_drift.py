from __future__ import annotations

from ledgerline import schemas
from ledgerline.operators import drift

DECLARED = schemas._struct(("id", schemas.T.LongType()), ("name", schemas.T.StringType()), ("gone", schemas.T.StringType()))
LINES = [
    '{"id": 1, "name": "a"}',
    '{"id": 2.5, "name": null, "more": true}',
    '{"id": "3", "name": {"first": "x"}, "more": [1]}',
    '{"id": 4, "name": [1, "b"], "Name": "other case"}',
    "no json {",
    None,
    "[1, 2]",
    "{}",
]


def rows(spark, lines):
    return sorted(map(tuple, drift.schema_drift(spark.createDataFrame([(x,) for x in lines], "value string"), DECLARED).collect()), key=repr)


def test_every_kind_of_difference(spark):
    want = [
        ("id", "number", "number", 3, "none"),
        ("id", "string", "number", 1, "other_type"),
        ("name", "string", "string", 1, "none"),
        ("name", "null", "string", 1, "none"),
        ("name", "object", "string", 1, "nested"),
        ("name", "array", "string", 1, "nested"),
        ("more", "boolean", None, 1, "unknown_field"),
        ("more", "array", None, 1, "unknown_field"),
        ("Name", "string", None, 1, "unknown_field"),
        ("gone", None, "string", 0, "missing_field"),
        (None, None, None, 1, "damaged"),
    ]
    assert rows(spark, LINES) == sorted(want, key=repr)


def test_nothing_delivered(spark):
    assert {r[4] for r in rows(spark, [])} == {"missing_field"}


def test_fields_are_counted_before_they_are_shuffled(spark):
    plan = drift.field_types(spark.createDataFrame([(x,) for x in LINES], "value string"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("HashAggregate") == 2
    assert "Python" not in plan
