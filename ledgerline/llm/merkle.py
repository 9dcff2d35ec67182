"""Merkle manifest of a corpus: a tree per source, one above them, and every row's proof.

Leaves are hashes of the rows. Per source they stand in order of ``doc_id``; runs of
``RUN`` consecutive nodes become their parent until one is left, the source's
subroot. Subroots in order of source become the root in the same way.

Proofs are made by pointer jumping. At first an inner node knows its parent and the
segment up to it: the run in which it stands, and its place there. In every turn the
table of nodes is joined with itself: a node that points to another takes over its
pointer and appends its segment to the own one, which doubles the distance. When all
point to the root, the leaves of a run, which share the segment that their parent
holds for them, join with that parent and so reach the root. Nodes and their paths
are broadcast while they are few, as the higher ones always are, and else shuffled.

Places are counted without a window over all rows of a source: rows are sorted by
ranges, numbered inside their range, and moved by the number of rows in the ranges
before, so that a source of any size is spread over tasks. The number of turns grows
with the logarithm of the tree's height.

Null columns are hashed as ``-``. A null ``doc_id`` comes first in its source and a
null source is a source of its own, before all others. Rows that repeat a
``doc_id`` are leaves in order of their hashes. An empty table has no rows and no
root. Further columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import dealt, materialize, release
from ledgerline.llm.ranks import numbered

RUN = 16
# The columns of a row that are hashed, in this order.
HASHED = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TAMPERED_OF = 5  # a row is tampered with if this divides its id's checksum

_STEP = "struct<slot:int,run:array<string>>"
# Fixed value: bytes of a step with its hashes, 64 characters each, as a row of Spark's holds it.
STEP_BYTES = 64 + RUN * (64 + 8)


def _no_steps() -> Column:
    return F.array().cast(f"array<{_STEP}>")


def _row_bytes(steps: int) -> Column:
    """Of a row with a path of ``steps`` steps at most."""
    return F.lit(128 + steps * STEP_BYTES)


def digest(text: Column) -> Column:
    return F.sha2(text, 256)


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(**changed: Column) -> Column:
    """The hash of a row; ``changed`` columns stand in for the row's own."""
    return digest(F.concat(*(_field(changed.get(c, F.col(c))) for c in HASHED)))


def tampered_rows() -> Column:
    return F.crc32(F.col("doc_id").cast("string")) % TAMPERED_OF == 0


def leaves(documents: DataFrame) -> DataFrame:
    """``doc_id``, ``source``, ``leaf``, and the ``tampered`` leaf of rows whose text was changed."""
    small = F.translate("text", UPPER, LOWER)
    kinds = {"doc_id": "bigint", "n_chars": "bigint"}
    rows = documents.select(*(F.col(f"`{c}`").cast(kinds.get(c, "string")).alias(c) for c in HASHED))
    changed = F.when(tampered_rows() & (small != F.col("text")), leaf(text=small))
    return rows.select("doc_id", "source", leaf().alias("leaf"), changed.alias("tampered"))


def _parents(nodes: DataFrame) -> DataFrame:
    """The parents of ``nodes`` (``tree``, ``place``, ``size`` of the level, ``hash``): the same, and the children's hashes, ``run``."""
    run = F.array_sort(F.collect_list(F.struct("place", "hash")))
    found = nodes.groupBy("tree", F.floor(F.col("place") / RUN).alias("parent")).agg(
        run.alias("run"), F.ceil(F.first("size") / RUN).alias("size")
    )
    hashes = F.transform("run", lambda x: x["hash"])
    found = found.select("tree", F.col("parent").alias("place"), "size", hashes.alias("run"))
    return found.withColumn("hash", digest(F.array_join("run", "")))


def _forest(nodes: DataFrame, purpose: str) -> tuple[DataFrame, list[DataFrame]]:
    """All inner nodes above ``nodes`` (``tree``, ``place``, ``size`` of the level, ``hash``), level by level.

    The first result has ``tree`` and ``hash`` of every tree's top; the second the
    levels' ``tree``, ``level``, ``place``, ``size``, ``run`` and ``hash``.
    """
    most = nodes.agg(F.max("size")).first()[0] or 0
    tops, levels = nodes.where("size = 1").select("tree", "hash"), []
    while most > 1:
        above = _parents(nodes.where("size > 1")).withColumn("level", F.lit(len(levels) + 1))
        nodes = materialize(above, f"merkle-{purpose}")
        levels.append(nodes)
        tops = tops.unionAll(nodes.where("size = 1").select("tree", "hash"))
        most = -(-most // RUN)
    return tops, levels


def _node(tree: Column, level: Column, place: Column) -> Column:
    return F.struct(tree.alias("tree"), level.cast("int").alias("level"), place.cast("bigint").alias("place"))


def jump(nodes: DataFrame) -> DataFrame:
    """``node`` and ``path``, its steps up to the top, of ``nodes`` with ``node``, ``up`` (null at the top) and ``path``.

    Every turn doubles the distance that a node's path covers.
    """
    nodes, steps = materialize(nodes, "merkle-jump"), 1
    while True:
        # Nodes that others point to stand higher with every turn, above the sources (trees below 0) and in them.
        outer = (F.col("up.tree") < 0).alias("outer")
        lowest = nodes.where("up is not null").groupBy(outer).agg(F.min("up.level").alias("level")).collect()
        if not lowest:
            return nodes
        reached = reduce(
            Column.__or__, (((F.col("node.tree") < 0) == F.lit(x.outer)) & (F.col("node.level") >= x.level) for x in lowest)
        )
        ahead = nodes.where(reached).select(F.col("node").alias("_node"), F.col("up").alias("_up"), F.col("path").alias("_path"))
        further = F.concat("path", F.coalesce("_path", _no_steps()))
        joined = nodes.join(dealt(ahead, _row_bytes(steps)), F.col("up") == F.col("_node"), "left")
        longer = materialize(joined.select("node", F.col("_up").alias("up"), further.alias("path")), "merkle-jump")
        release(nodes)
        nodes, steps = longer, 2 * steps


def _steps(levels: list[DataFrame]) -> DataFrame:
    """``node``, its parent ``up``, its ``slot`` there, and the ``run`` that it holds for its children."""
    node = _node(F.col("tree"), F.col("level"), F.col("place"))
    parent = _node(F.col("tree"), F.col("level") + 1, F.floor(F.col("place") / RUN))
    rows = levels[0]
    for more in levels[1:]:
        rows = rows.unionByName(more)
    slot = (F.col("place") % RUN).alias("slot")
    return rows.select(node.alias("node"), F.when(F.col("size") > 1, parent).alias("up"), slot, "run")


def folded(start: Column, path: Column) -> Column:
    """The root that ``start`` gives with the siblings of ``path``."""

    def fold(acc: Column, step: Column) -> Column:
        left = F.array_join(F.slice(step["run"], F.lit(1), step["slot"]), "")
        right = F.array_join(F.slice(step["run"], step["slot"] + 2, F.lit(RUN)), "")
        return digest(F.concat(left, acc, right))

    return F.aggregate(path, start, fold)


def proof(path: Column) -> Column:
    """The hash of all siblings of ``path``, from the leaf to the root, left to right."""
    others = F.transform(
        path,
        lambda step: F.concat(
            F.array_join(F.slice(step["run"], F.lit(1), step["slot"]), ""),
            F.array_join(F.slice(step["run"], step["slot"] + 2, F.lit(RUN)), ""),
        ),
    )
    return digest(F.array_join(others, ""))


def _inner_paths(levels: list[DataFrame], above: list[DataFrame]) -> DataFrame:
    """``_node``, the ``run`` of its children, and its ``path`` to the root, of all nodes but leaves."""
    steps = _steps([*levels, *above])
    # Above a source's top the path goes on with its subroot's place among the subroots.
    crosses = F.col("up").isNull() & (F.col("node.tree") >= 0) & F.lit(bool(above))
    outer = _node(F.lit(-1), F.lit(1), F.floor(F.col("node.tree") / RUN))
    slot = F.when(crosses, F.col("node.tree") % RUN).otherwise(F.col("slot")).cast("int")
    links = steps.select("node", F.when(crosses, outer).otherwise(F.col("up")).alias("up"), slot.alias("slot"), "run")
    links = materialize(links, "merkle-links")
    # A node's first segment is its parent's run and its own place there.
    parents = links.where("node.level > 1 or node.tree < 0")
    runs = dealt(parents.select(F.col("node").alias("_node"), F.col("run").alias("_run")), _row_bytes(1))
    segment = F.array(F.struct(F.col("slot"), F.col("_run").alias("run")).cast(_STEP))
    first = links.join(runs, F.col("up") == F.col("_node"), "left").select(
        "node", "up", F.when(F.col("up").isNotNull(), segment).otherwise(_no_steps()).alias("path")
    )
    jumped = jump(first)
    below = dealt(links.select(F.col("node").alias("_node"), "run"), _row_bytes(1))
    found = materialize(jumped.join(below, F.col("node") == F.col("_node")).select("_node", "run", "path"), "merkle-paths")
    release(links, jumped)
    return found


def manifest(documents: DataFrame) -> DataFrame:
    """One row per document: its leaf, subroot, root, ``path``, and the ``tampered`` leaf if its text was changed."""
    rows = materialize(leaves(documents), "merkle-leaves")
    placed, scratch = numbered(rows, "source", "doc_id", "leaf")
    # A source is known by its number: it may be null, and its name long.
    sources = materialize(placed.where("place = 0").select("source", F.lit(0).alias("all")), "merkle-sources")
    trees, more = numbered(sources, "all", "source")
    trees = materialize(trees.select(F.col("source").alias("_source"), F.col("place").alias("tree")), "merkle-trees")
    name_bytes = F.coalesce(F.octet_length("_source"), F.lit(0))
    leafs = placed.join(dealt(trees, name_bytes + 64), F.col("source").eqNullSafe(F.col("_source"))).select(
        "doc_id", "tree", "place", F.col("group_size").alias("size"), "leaf", "tampered"
    )
    leafs = materialize(leafs, "merkle-placed")
    release(rows, sources, trees, *scratch, *more)

    tops, levels = _forest(leafs.select("tree", "place", "size", F.col("leaf").alias("hash")), "source")
    subroots = materialize(tops.withColumnRenamed("hash", "subroot"), "merkle-subroots")
    top = subroots.select(
        F.lit(-1).cast("bigint").alias("tree"), F.col("tree").alias("place"),
        F.lit(subroots.count()).cast("bigint").alias("size"), F.col("subroot").alias("hash"),
    )
    roots, above = _forest(top, "root")
    root = roots.first()  # one row, or none without documents
    own = leafs.join(dealt(subroots, _row_bytes(0)), "tree").withColumn("root", F.lit(root.hash if root else None).cast("string"))
    if not levels and not above:
        return own.select("doc_id", "leaf", "tampered", "subroot", "root", _no_steps().alias("path"))
    paths = _inner_paths(levels, above)
    release(*levels, *above)
    # A leaf alone in its source stands among the subroots itself.
    alone = F.col("size") == 1
    parent = F.when(~alone, _node(F.col("tree"), F.lit(1), F.floor(F.col("place") / RUN))).when(
        F.lit(bool(above)), _node(F.lit(-1), F.lit(1), F.floor(F.col("tree") / RUN))
    )
    slot = F.when(alone, F.col("tree")).otherwise(F.col("place")) % RUN
    own = own.withColumn("up", parent).withColumn("slot", slot.cast("int"))
    step = F.array(F.struct("slot", "run").cast(_STEP))
    path = F.when(F.col("_node").isNotNull(), F.concat(step, F.col("path"))).otherwise(_no_steps())
    paths = dealt(paths, _row_bytes(1 + len(levels) + len(above)))
    joined = own.join(paths, F.col("up") == F.col("_node"), "left")
    return joined.select("doc_id", "leaf", "tampered", "subroot", "root", path.alias("path"))


def verify(documents: DataFrame) -> DataFrame:
    """The manifest's digests, and whether each row, some of them tampered with, still leads to the root."""
    rows = manifest(documents)
    start = F.coalesce("tampered", "leaf")
    return rows.select(
        "doc_id", "leaf", "subroot", "root", proof(F.col("path")).alias("proof_sha256"),
        folded(start, F.col("path")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
