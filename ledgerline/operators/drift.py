"""What a JSON delivery holds, compared with the declared columns.

Nothing is inferred on the driver: every line is parsed where it is read, its fields'
types are counted inside the map tasks, and a row for each field and type is left.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

NONE, UNKNOWN, OTHER_TYPE, NESTED, MISSING, DAMAGED = "none", "unknown_field", "other_type", "nested", "missing_field", "damaged"

# What the types of a parsed value are called here, by their beginnings.
_KINDS = {"OBJECT": "object", "ARRAY": "array", "STRING": "string", "BOOLEAN": "boolean", "VOID": "null"}


def _kind(value: Column) -> Column:
    found = F.schema_of_variant(value)
    kind = F.when(F.lit(False), F.lit(""))
    for start, name in _KINDS.items():
        kind = kind.when(found.startswith(start), F.lit(name))
    return kind.otherwise(F.lit("number"))


def _declared(kind: T.DataType) -> str:
    return "number" if isinstance(kind, T.NumericType) else "boolean" if isinstance(kind, T.BooleanType) else "string"


def field_types(lines: DataFrame, column: str = "value") -> DataFrame:
    """``FIELD``, ``FOUND`` and ``ROWS``: how many records hold the field with a value of that type."""
    records = lines.select(F.try_parse_json(F.col(column)).alias("record")).where("record is not null")
    fields = records.lateralJoin(lines.sparkSession.tvf.variant_explode(F.col("record").outer()))
    fields = fields.where("key is not null").select(F.col("key").alias("FIELD"), _kind(F.col("value")).alias("FOUND"))
    return fields.groupBy("FIELD", "FOUND").agg(F.count("*").alias("ROWS"))


def schema_drift(lines: DataFrame, declared: T.StructType, column: str = "value") -> DataFrame:
    """Every delivered field and type with the declared one, and how they differ: ``DRIFT``.

    A declared column that no record holds has a row of its own, and so have lines that
    are no JSON, if there are any. NULL values differ from no type. Names count as they
    are spelt.
    """
    spark = lines.sparkSession
    wanted = spark.createDataFrame([(f.name, _declared(f.dataType)) for f in declared], "FIELD string, DECLARED string")
    found = field_types(lines, column).join(wanted, "FIELD", "full")
    drift = (
        F.when(F.col("FOUND").isNull(), MISSING)
        .when(F.col("DECLARED").isNull(), UNKNOWN)
        .when(F.col("FOUND").isin("object", "array"), NESTED)
        .when((F.col("FOUND") == "null") | (F.col("FOUND") == F.col("DECLARED")), NONE)
        .otherwise(OTHER_TYPE)
    )
    found = found.select("FIELD", "FOUND", "DECLARED", F.coalesce("ROWS", F.lit(0)).alias("ROWS"), drift.alias("DRIFT"))
    bad = lines.where(F.col(column).isNotNull() & F.try_parse_json(F.col(column)).isNull()).agg(F.count("*").alias("n")).where("n > 0")
    return found.unionAll(bad.select(F.lit(None), F.lit(None), F.lit(None), "n", F.lit(DAMAGED)))
