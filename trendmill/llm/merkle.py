"""Merkle manifest of a table: a tree for each group of rows, a tree over the groups, and a proof for each row.

A node is the lower-case hex SHA-256 of its children's digests, as hex text, one after the other. Nodes of a
level stand in runs of ``arity``; the last run may be shorter, even a single node, and is hashed all the same.

A level is a table of (grp, i, n, node): the group, the node's number in the level, how many nodes the group
has there, and the digest. One equijoin of the level with itself, on the numbers of the siblings, gives every
node its siblings; rows of slot zero then emit the parents. All groups go up together, and no task holds one.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trendmill.operators.scale import join_on_group
from trendmill.session import stage


LEVELS_AT_ONCE = 6  # joins of one job on the way down


def encoded(column: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, a colon, and the value; integers are decimal."""
    text = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(columns: list[Column]) -> Column:
    """The digest of a row with these values."""
    return F.sha2(F.concat(*[encoded(column) for column in columns]), 256)


def _hex(node: Column) -> Column:
    return F.lower(F.hex(node))


def folded(start: Column, steps: Column) -> Column:
    """The root that a leaf's digest leads to over the ``steps`` of a proof (before, after: the siblings on each side)."""
    return F.aggregate(steps, start, lambda node, s: F.sha2(F.concat(_hex(s["before"]), node, _hex(s["after"])), 256))


def proof_digest(steps: Column) -> Column:
    """The digest of all siblings in a proof, from the leaf to the root and left to right."""
    return F.sha2(F.array_join(F.transform(steps, lambda s: F.concat(_hex(s["before"]), _hex(s["after"]))), ""), 256)


def _numbered(rows: DataFrame, group: list[str], order: list[str], label: str) -> DataFrame:
    """``rows`` with i, their number in the group from 0 in ``order`` (ascending, nulls first).

    Rows are range-partitioned over group and order, so that a large group is spread over many tasks,
    and stored with their place in their task; each task's rows of a group go on where those of the
    tasks before end.
    """
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(c).asc_nulls_first() for c in [*group, *order]]
    sorted_rows = rows.repartitionByRange(tasks, *keys).sortWithinPartitions(*keys)
    placed = stage(sorted_rows.withColumn("at", F.monotonically_increasing_id()), label)
    placed = placed.withColumn("cell", F.shiftrightunsigned("at", 33))  # the upper bits are the task's number
    counts = placed.groupBy("cell", *group).agg(F.min("at").alias("first"), F.count("*").alias("rows"))
    before = Window.partitionBy(*(group or [F.lit(0)])).orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("rows").over(before), F.lit(0)) - F.col("first")
    shifts = stage(counts.select("cell", *group, shift.alias("shift")), f"{label}-shifts")
    return join_on_group(placed, shifts, ["cell", *group]).withColumn("i", F.col("at") + F.col("shift")).drop("at", "cell", "shift")


def _siblings(nodes: DataFrame, arity: int) -> DataFrame:
    """``nodes`` with before and after: the digests of their siblings on each side, one after the other."""
    empty = F.lit("").cast("binary")
    if arity == 2:
        other = nodes.select("grp", F.col("i").bitwiseXOR(F.lit(1)).alias("i"), F.col("node").alias("other"))
        right = F.col("i") % 2 == 1
        before = F.when(right, F.col("other")).otherwise(empty)
        after = F.when(right, empty).otherwise(F.coalesce("other", empty))
        return nodes.join(other, ["grp", "i"], "left").withColumns({"before": before, "after": after}).drop("other")
    slot = F.col("i") % arity
    shifts = nodes.select("grp", "i", "node", slot.alias("slot"), F.explode(F.sequence(F.lit(1), F.lit(arity - 1))).alias("shift"))
    of = F.col("i") - F.col("slot") + (F.col("slot") + F.col("shift")) % arity
    other = shifts.select("grp", of.alias("i"), F.struct("slot", "node").alias("one"))
    other = other.groupBy("grp", "i").agg(F.array_sort(F.collect_list("one")).alias("others"))

    def side(keep) -> Column:
        own = F.filter(F.coalesce("others", F.array().cast("array<struct<slot: bigint, node: binary>>")), keep)
        return F.aggregate(own, empty, lambda found, one: F.concat(found, one["node"]))

    joined = nodes.join(other, ["grp", "i"], "left")
    return joined.withColumns({"before": side(lambda x: x["slot"] < slot), "after": side(lambda x: x["slot"] > slot)}).drop("others")


def _levels(leaves: DataFrame, arity: int, height: int, label: str) -> tuple[list[DataFrame], DataFrame]:
    """The stored levels, with siblings, of groups of more than one node, and the top of each group (grp, level, node)."""
    nodes, levels = leaves, []
    tops = [nodes.where("n = 1").select("grp", F.lit(0).alias("level"), "node")]
    parent = F.unhex(F.sha2(F.concat(_hex(F.col("before")), _hex(F.col("node")), _hex(F.col("after"))), 256))
    for level in range(height):
        rows = stage(_siblings(nodes.where("n > 1"), arity), f"{label}{level}")
        levels.append(rows)
        nodes = rows.where(F.col("i") % arity == 0).select(
            "grp", F.expr(f"i div {arity}").alias("i"), F.expr(f"(n + {arity - 1}) div {arity}").alias("n"), parent.alias("node")
        )
        tops.append(nodes.where("n = 1").select("grp", F.lit(level + 1).alias("level"), "node"))
    return levels, reduce(DataFrame.unionByName, tops)


def _paths(levels: list[DataFrame], ends: DataFrame, arity: int, names: list[str]) -> DataFrame:
    """grp, i, steps and ``names`` of every leaf, from those that ``ends`` (grp, level, ...) gives for each top."""
    found = ends.where(F.col("level") == len(levels)).select("grp", F.lit(0).cast("long").alias("i"), "steps", *names)
    for level, rows in reversed(list(enumerate(levels))):
        above = found.select("grp", F.col("i").alias("up"), F.col("steps").alias("more"), *names)
        own = rows.select("grp", "i", F.expr(f"i div {arity}").alias("up"), F.struct("before", "after").alias("step"))
        found = own.join(above, ["grp", "up"]).select("grp", "i", F.concat(F.array("step"), "more").alias("steps"), *names)
        lone = ends.where(F.col("level") == level).select("grp", F.lit(0).cast("long").alias("i"), "steps", *names)
        found = found.unionByName(lone)
        if level and level % LEVELS_AT_ONCE == 0:
            found = stage(found, "paths")
    return found


def _height(n: int, arity: int) -> int:
    height = 0
    while n > 1:
        n, height = -(-n // arity), height + 1
    return height


def manifest(
    docs: DataFrame,
    columns: list[str],
    id_column: str = "doc_id",
    group_column: str = "lang",
    arity: int = 2,
    carry: dict[str, Column] | None = None,
) -> DataFrame:
    """doc_id, leaf, subroot, root, steps and the ``carry`` columns of each row of ``docs``.

    A leaf is over the values of ``columns``, in this order. In a group leaves ascend by id; the
    groups' roots, ``subroot``, ascend by the group's value (bytewise, null first, as null ids), and
    likewise give ``root``. ``steps`` is the row's proof, from the leaf to the root: the siblings
    (binary digests, one after the other) before and after it. Rows of one id are ordered by their
    digests; repeated rows are leaves of their own, any of which may have any of their places. Null
    and empty texts have different leaves. An empty table has no rows and no root. Other columns of
    ``docs`` may have any name.

    Digests alone are shuffled, never texts. Levels are stored in the shared folder, so each step
    reads what the one before has written; so do the paths, every few levels on the way down.
    """
    carry, spark = carry or {}, docs.sparkSession
    values = [docs[f"`{name}`"] for name in columns]
    leaves = stage(
        docs.select(
            docs[f"`{id_column}`"].alias("doc_id"), docs[f"`{group_column}`"].alias("own_group"), F.unhex(leaf(values)).alias("node"),
            F.monotonically_increasing_id().alias("row"), F.struct(F.lit(0).alias("_"), *[c.alias(k) for k, c in carry.items()]).alias("carried"),
        ),
        "leaves",
    )
    rows = _numbered(leaves, ["own_group"], ["doc_id", "node", "row"], "numbered")
    sizes = rows.groupBy("own_group").agg(F.count("*").alias("n"))
    groups = stage(_numbered(sizes, [], ["own_group"], "groups").withColumnRenamed("i", "grp"), "groups")
    n_groups, largest = groups.agg(F.count("*"), F.coalesce(F.max("n"), F.lit(0))).first()
    rows = stage(join_on_group(rows, groups, ["own_group"]).drop("own_group", "row"), "rows")

    levels, tops = _levels(rows.select("grp", "i", "n", "node"), arity, _height(largest, arity), "level")
    tops = stage(tops, "tops")
    upper = tops.select(F.lit(0).cast("long").alias("grp"), F.col("grp").alias("i"), F.lit(n_groups).cast("long").alias("n"), "node")
    upper_levels, root = _levels(upper, arity, _height(n_groups, arity), "upper")
    none = F.array().cast("array<struct<before: binary, after: binary>>")
    root = root.select("grp", "level", F.col("node").alias("root"), none.alias("steps"))
    ends = _paths(upper_levels, stage(root, "root"), arity, ["root"]).select(F.col("i").alias("grp"), "steps", "root")
    ends = stage(tops.withColumnRenamed("node", "subroot").join(ends, "grp"), "ends")
    paths = _paths(levels, ends, arity, ["subroot", "root"])
    kept = [F.col(f"carried.`{name}`") for name in carry]
    return rows.join(paths, ["grp", "i"]).select(
        "doc_id", _hex(F.col("node")).alias("leaf"), _hex(F.col("subroot")).alias("subroot"), _hex(F.col("root")).alias("root"), "steps", *kept
    )


def root_of(manifested: DataFrame) -> str | None:
    """The root of a manifest; None for one without rows."""
    first = manifested.select("root").first()
    return first[0] if first else None


def changed(docs: DataFrame, manifested: DataFrame, columns: list[str], id_column: str = "doc_id") -> DataFrame:
    """doc_id of rows of ``docs`` that no proof of their id leads to the root, so not as they were.

    Compares with the leaves of the manifest, whose proofs are checked. A new id is a change, as a
    null id is like any other; a row that is gone is not in ``docs`` and so not found.
    """
    sound = manifested.where(folded(F.col("leaf"), F.col("steps")) == F.col("root")).select("doc_id", "leaf").distinct()
    now = docs.select(docs[f"`{id_column}`"].alias("doc_id"), leaf([docs[f"`{c}`"] for c in columns]).alias("leaf"))
    return now.join(sound, now["doc_id"].eqNullSafe(sound["doc_id"]) & (now["leaf"] == sound["leaf"]), "left_anti").select("doc_id")
