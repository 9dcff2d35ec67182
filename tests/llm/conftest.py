from __future__ import annotations

import pytest

SF_DIR = "/root/testdata/sf0.001"

# Every operator gets these texts in its tests of special cases.
PROSE = "The harbour was quiet when the first boats came back and the men on the pier counted them one by one."
SECOND = "Nobody spoke of the weather, which had kept them out since early spring, and the cook lit the stove again."
LONG = " ".join(f"word{i % 977}x{i % 31}" for i in range(30_000)) + "."
EDGE_TEXTS = [
    (1, PROSE + "\n" + SECOND),
    (2, PROSE + "\n" + SECOND),  # a copy
    (3, ""),
    (4, None),
    (5, " \n\t\r\n "),
    (6, "one"),
    (7, "two words"),
    (8, LONG),
    (8, LONG),  # a repeated row
    (9, "Zażółć gęślą jaźń \U0001f600 naïve café " * 9),
    (None, PROSE),
    (None, None),
    (10, "### | ### | ### | ### | ### | ### | ### | ### | ### | ### | ### | ### | ### | ### | ### |"),
    (11, "same line here\n" * 50),
    (12, "a" * 5000),
]


@pytest.fixture(scope="session")
def edge_documents(spark):
    """The special cases, with further columns whose names the operators use inside."""
    rows = [(i, t, "x", None if t is None else len(t), k, float(k), "y") for k, (i, t) in enumerate(EDGE_TEXTS)]
    names = "doc_id bigint, text string, print string, n_chars bigint, length bigint, n double, bucket string"
    return spark.createDataFrame(rows, names).repartition(3)


@pytest.fixture(scope="session")
def no_documents(spark):
    return spark.createDataFrame([], "doc_id bigint, text string")


@pytest.fixture(scope="session")
def tables():
    import duckdb

    con = duckdb.connect()
    return {
        name: con.sql(f"SELECT * FROM '{SF_DIR}/{name}.parquet'").fetchall() for name in ("documents", "pages", "benchmark")
    }


def rows(df, *columns):
    """Rows of ``df`` in a fixed order."""
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)
