"""A dataset manifest as a content-addressed tree of digests, in DataFrame operations only.

Rows are leaves; sixteen neighbours in rank order are one record, digest to children, up to one root per group
and one over the groups. A proof starts at the root: the digits of a leaf's rank name a child at each record on the way
down, its siblings are collected, and the path is reversed at the end. Leaves of the same record share their way down.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorloom.session import written

FAN = 16
#: Fields of a leaf, in this order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_SEGMENT = "array<struct<left:string,right:string>>"
#: What explodes into rows with paths is not to be broadcast: once a join below it was, Spark takes that broadcast's size
#: for the size of all rows made of it, sixteen times as many at each record on the way down, and they end up in the driver.
_NEVER_BROADCAST = "merge"


def digest(value: Column) -> Column:
    return F.sha2(value, 256)


def leaf(fields: list[Column]) -> Column:
    """Digest of the fields, each ``-`` if null, else its length in UTF-8 bytes, a colon and its value."""
    def one(c: Column) -> Column:
        s = c.cast("string")
        return F.when(c.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s))
    return digest(F.concat(*[one(c) for c in fields]))


def ranked(rows: DataFrame, group: str, order: list[str], label: str) -> DataFrame:
    """``rows`` with ``_rank`` (from 0) and ``_total`` inside their group; no group is one task.

    Rows are dealt in ranges of (group, order) and numbered where they lie. Only the counts per range and group,
    one row per range a group lies in, are summed along the ranges.
    """
    keys = [group, *order]
    placed = written(rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_at", F.monotonically_increasing_id()), label)
    placed = placed.withColumn("_range", F.shiftright("_at", 33))
    runs = placed.groupBy("_range", group).agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    along = Window.partitionBy(group).orderBy("_range")
    before = F.coalesce(F.sum("_n").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    total = F.sum("_n").over(along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    runs = runs.select(F.col("_range").alias("_of_range"), F.col(group).alias("_of"), (before - F.col("_first")).alias("_shift"), total.alias("_total"))
    runs = written(runs, f"{label}-runs")
    d = placed.join(runs, (F.col("_range") == F.col("_of_range")) & F.col(group).eqNullSafe(F.col("_of")))
    return d.withColumn("_rank", F.col("_at") + F.col("_shift")).drop("_at", "_range", "_of_range", "_of", "_shift")


@dataclass(frozen=True)
class Manifest:
    """``records[h - 1]`` and ``top[h - 1]`` hold the records of height h: (digest, children), with their place (_tree, _rank).

    ``trees``: group, number of leaves, rank and subroot of each group; ``lone``: leaves that are a group of their own;
    ``root``: the digest of everything, null for an empty table.
    """

    records: list[DataFrame]
    top: list[DataFrame]
    trees: DataFrame
    lone: DataFrame
    root: str | None

    def store(self) -> DataFrame:
        """(digest, children) of all records."""
        out = None
        for t in [*self.records, *self.top]:
            t = t.select("digest", F.transform("_run", lambda c: c["digest"]).alias("children"))
            out = t if out is None else out.union(t)
        return out.distinct() if out is not None else self.trees.select(F.col("digest"), F.array("digest").alias("children")).limit(0)


def _levels(size: int) -> int:
    n = 0
    while size > 1:
        size, n = -(-size // FAN), n + 1
    return n


def climb(nodes: DataFrame, payload: list[str], label: str) -> tuple[list[DataFrame], DataFrame]:
    """Records by height from (_tree, _total, _rank, digest, payload), and (_tree, _total, digest) of each tree's root.

    A record's ``_run`` lists its children in rank order: digit, digest and, at height 1, the leaf's payload.
    One number, the largest tree's size, reaches the driver.
    """
    most = nodes.agg(F.max("_total")).first()[0] or 0
    tops = nodes.where("_total = 1").select("_tree", "_total", "digest")
    d, held, tables = nodes.where("_total > 1").withColumn("_size", F.col("_total")), payload, []
    for _ in range(_levels(most)):
        child = F.struct((F.col("_rank") % FAN).cast("int").alias("digit"), "digest", *held)
        d = d.withColumns({"_child": child, "_rank": F.floor(F.col("_rank") / FAN), "_size": F.ceil(F.col("_size") / FAN)})
        d = d.groupBy("_tree", "_total", "_size", "_rank").agg(F.array_sort(F.collect_list("_child")).alias("_run"))
        table = written(d.withColumn("digest", digest(F.concat_ws("", F.transform("_run", lambda c: c["digest"])))), label)
        tables.append(table)
        tops = tops.union(table.where("_size = 1").select("_tree", "_total", "digest"))
        d, held = table.where("_size > 1").drop("_run"), []
    return tables, tops


def build(docs: DataFrame, payload: dict[str, Column] | None = None, *, fields: tuple[str, ...] = FIELDS, group_col: str = "source", order_col: str = "doc_id") -> Manifest:
    """The manifest of ``docs``; ``payload`` are columns that leaves carry along beside their digest.

    Leaves of a group ascend by ``order_col`` (null first), rows equal there by digest, so repeated rows are leaves of
    their own and their order is of no matter. Groups ascend bytewise, null first; a null group is a group of its own.
    A lone leaf is its group's subroot, a lone group's subroot the root. An empty table has no root.
    Texts are read once; digests, ranks and records are written to the shared folder.
    """
    payload = payload or {}
    rows = docs.select(F.col(group_col).alias("_tree"), F.col(order_col).alias("_order"), leaf([F.col(c) for c in fields]).alias("digest"), *[c.alias(k) for k, c in payload.items()])
    leaves = written(ranked(written(rows, "leaves"), "_tree", ["_order", "digest"], "ranks").drop("_order"), "ranked")
    records, subroots = climb(leaves, list(payload), "records")
    named = subroots.select(F.lit(0).alias("_all"), F.col("_tree").alias("group"), F.col("_total").alias("leaves"), "digest")
    trees = ranked(named, "_all", ["group"], "groups").withColumnRenamed("_all", "_tree")
    trees = written(trees, "trees")
    top, root = climb(trees, ["group", "leaves"], "top")
    first = root.first()
    return Manifest(records, top, trees, leaves.where("_total = 1"), first["digest"] if first else None)


def _opened(nodes: DataFrame, records: DataFrame, more: list[str]) -> DataFrame:
    """The children of ``nodes``, each with the segment of its siblings added to its path."""
    # Equal rows may make equal records.
    known = records.select("digest", "_run").dropDuplicates(["digest"])
    d = nodes.hint(_NEVER_BROADCAST).join(known, "digest").withColumn("_list", F.transform("_run", lambda c: c["digest"]))
    d = d.select(*[c for c in nodes.columns if c != "digest"], "_list", F.posexplode("_run").alias("_digit", "_child"))
    d = d.withColumns({"_path": F.array_append("_path", _segment("_list", "_digit")), "_rank": F.col("_rank") * FAN + F.col("_digit"), "digest": F.col("_child.digest")})
    d = d.withColumns({c: F.col(f"_child.{c}") for c in more})
    return d.drop("_list", "_digit", "_child")


def _segment(children: str, digit: str) -> Column:
    """What stands left and right of a child."""
    left = F.concat_ws("", F.slice(children, F.lit(1), F.col(digit)))
    right = F.concat_ws("", F.slice(children, F.col(digit) + 2, F.size(children)))
    return F.struct(left.alias("left"), right.alias("right"))


def proofs(m: Manifest, wanted: Column | None = None) -> DataFrame:
    """(digest, payload, ``subroot``, ``root``, ``path``) of each leaf; a path's segments go from the leaf up to the root.

    ``wanted`` is a condition on ``digest`` and the payload columns; only records above wanted leaves are then opened.
    Nodes go down record by record, each once for all leaves below it; a join on the digest opens them, so no digest
    gathers the requests of many leaves, and only the last step has a row per leaf. No path reaches the driver.
    """
    start = m.trees
    paths = F.array().cast(_SEGMENT)
    if m.top:
        above = m.top[-1].select("digest", F.lit(0).cast("long").alias("_rank"), paths.alias("_path"))
        for h in range(len(m.top), 0, -1):
            above = _opened(above, m.top[h - 1], ["group", "leaves"] if h == 1 else [])
        start = above
    else:
        start = start.withColumn("_path", paths)
    start = written(start.select(F.col("group").alias("_tree"), F.col("leaves").alias("_total"), "digest", F.col("digest").alias("subroot"), "_path", F.lit(0).cast("long").alias("_rank")), "subroots")
    left = F.lit(0)
    for h in range(len(m.records)):
        left = F.when(F.col("_total") > FAN**h, F.lit(h + 1)).otherwise(left)
    start = start.withColumn("_left", left)

    asked = None
    if m.records:
        asked = m.records[0].select(F.col("_tree").alias("_of"), F.col("_rank").alias("_at"), "_run")
        if wanted is not None:
            leaves = asked.select("_of", "_at", F.explode("_run").alias("_l")).select("_of", "_at", "_l.*").where(wanted)
            asked = asked.join(leaves.select("_of", "_at").distinct().withColumnsRenamed({"_of": "_o", "_at": "_a"}), F.col("_of").eqNullSafe(F.col("_o")) & (F.col("_at") == F.col("_a")), "left_semi")

    def at(h: int) -> DataFrame:
        return start.where(F.col("_left") == h).drop("_left", "_total")

    nodes = None
    for h in range(len(m.records), 0, -1):
        nodes = at(h) if nodes is None else nodes.unionByName(at(h))
        if wanted is not None:
            below = asked.select(F.col("_of").alias("_o"), F.floor(F.col("_at") / FAN ** (h - 1)).alias("_a")).distinct()
            nodes = nodes.join(below, F.col("_tree").eqNullSafe(F.col("_o")) & (F.col("_rank") == F.col("_a")), "left_semi")
        if h > 1:
            nodes = _opened(nodes, m.records[h - 1], [])
    lone = m.lone.drop("_total", "_rank").withColumnRenamed("_tree", "_of")
    lone = lone.join(at(0).select("_tree", "subroot", "_path").hint(_NEVER_BROADCAST), F.col("_of").eqNullSafe(F.col("_tree")))
    payload = [c for c in m.lone.columns if c not in ("_tree", "_total", "_rank", "digest")]
    out = lone.select("digest", *payload, "subroot", "_path")
    if nodes is not None:
        met = nodes.drop("digest").hint(_NEVER_BROADCAST).join(asked, F.col("_tree").eqNullSafe(F.col("_of")) & (F.col("_rank") == F.col("_at")))
        met = met.withColumn("_list", F.transform("_run", lambda c: c["digest"])).select("subroot", "_path", "_list", F.posexplode("_run").alias("_digit", "_l"))
        out = out.unionByName(met.select("_l.digest", *[f"_l.{c}" for c in payload], "subroot", F.array_append("_path", _segment("_list", "_digit")).alias("_path")))
    if wanted is not None:
        out = out.where(wanted)
    return out.select("digest", *payload, "subroot", F.lit(m.root).alias("root"), F.reverse("_path").alias("path"))


def siblings(path: Column) -> Column:
    """All sibling digests of a path, joined."""
    return F.concat_ws("", F.transform(path, lambda s: F.concat(s["left"], s["right"])))


def folded(start: Column, path: Column) -> Column:
    """The root that a leaf's digest and its path lead to."""
    return F.aggregate(path, start, lambda acc, s: digest(F.concat(s["left"], acc, s["right"])))
