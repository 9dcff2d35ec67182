"""Tables that grow by parts, and one list that says which parts make up each of them.

A part is a folder written by one Spark job and never changed. The list of a bank
names the parts of all its tables; a new list is a new numbered file, created only
if no other writer has created it. So several tables change together or not at all,
readers see the parts of one list, and of two writers that began with the same list
one learns that the other was first.

Where some partitions of a part have been replaced, the list names them and readers
leave them out; their files are not touched. Parts that no list names any more, and
those of writers that failed, are left to a clean-up of the folder.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ledgerline.sinks import files

LISTS = "_lists"
# So many times a change is made anew because another writer was first.
ATTEMPTS = 5


class Conflict(Exception):
    """Another writer committed first."""


@dataclass(frozen=True)
class Part:
    """A part's folder below the root, and the partitions of it that no longer count."""

    folder: str
    without: tuple[tuple[tuple[str, int], ...], ...] = ()

    def kept(self) -> Column | None:
        """True for rows that count; a null partition value is never replaced."""
        if not self.without:
            return None
        gone = [reduce(Column.__and__, [F.col(c).eqNullSafe(F.lit(v)) for c, v in one]) for one in self.without]
        return ~reduce(Column.__or__, gone)


@dataclass(frozen=True)
class Listing:
    """The numbered list: each table's parts, and what else its writer notes."""

    number: int = 0
    tables: dict[str, list[Part]] = field(default_factory=dict)

    def with_parts(self, **changed: list[Part]) -> Listing:
        return Listing(self.number, {**self.tables, **changed})


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _file_system(spark: SparkSession, path):
    return path.getFileSystem(spark._jsc.hadoopConfiguration())


def _decode(text: str) -> dict[str, list[Part]]:
    raw = json.loads(text)
    as_part = lambda x: Part(x["folder"], tuple(tuple((c, v) for c, v in one) for one in x["without"]))
    return {table: [as_part(x) for x in parts] for table, parts in raw.items()}


def current(spark: SparkSession, root: str) -> Listing:
    """The last list; an empty one before the first."""
    folder = _path(spark, f"{root}/{LISTS}")
    fs = _file_system(spark, folder)
    if not fs.exists(folder):
        return Listing()
    numbers = sorted(int(s.getPath().getName()) for s in fs.listStatus(folder) if s.getPath().getName().isdigit())
    for number in reversed(numbers):
        rows = spark.read.text(f"{root}/{LISTS}/{number:020d}", wholetext=True).collect()
        try:
            return Listing(number, _decode(rows[0].value))
        except (IndexError, ValueError):
            continue  # its writer has not finished it
    return Listing()


def commit(spark: SparkSession, root: str, new: Listing) -> Listing:
    """Makes ``new``, made from the list of its number, the next one; raises ``Conflict`` when there is a next one."""
    number = new.number + 1
    path = _path(spark, f"{root}/{LISTS}/{number:020d}")
    fs = _file_system(spark, path)
    tables = {t: [{"folder": p.folder, "without": p.without} for p in parts] for t, parts in new.tables.items()}
    try:
        out = fs.create(path, False)
    except Exception as error:
        if fs.exists(path):
            raise Conflict(f"list {number} of {root} is there already") from error
        raise
    out.write(bytearray(json.dumps(tables, indent=1).encode()))
    out.close()
    return Listing(number, new.tables)


def change(spark: SparkSession, root: str, make: Callable[[Listing], Listing]) -> Listing:
    """Commits what ``make`` makes of the current list, again when another writer was first."""
    for attempt in range(ATTEMPTS):
        try:
            return commit(spark, root, make(current(spark, root)))
        except Conflict:
            if attempt == ATTEMPTS - 1:
                raise
    raise AssertionError("unreachable")


def write_part(df: DataFrame, root: str, table: str, partition_by: tuple[str, ...] = (), lookup_by: tuple[str, ...] = ()) -> Part:
    """Writes a part that no list names yet."""
    folder = f"{table}/{uuid.uuid4().hex}"
    files.write_table(df, f"{root}/{folder}", "errorifexists", partition_by, lookup_by)
    return Part(folder)


def read_parts(spark: SparkSession, root: str, parts: list[Part], schema: T.StructType) -> DataFrame:
    """The rows of ``parts`` that count. Replaced partitions are left out by their folders."""
    frames = []
    for part in parts:
        rows, kept = spark.read.schema(schema).parquet(f"{root}/{part.folder}"), part.kept()
        frames.append(rows if kept is None else rows.where(kept))
    if not frames:
        return spark.createDataFrame([], schema)
    return reduce(DataFrame.unionByName, frames).select(*schema.names)


def read_listed(spark: SparkSession, root: str, table: str, schema: T.StructType) -> DataFrame:
    """A table as the current list has it."""
    return read_parts(spark, root, current(spark, root).tables.get(table, []), schema)
