"""K-d tree sharding: weighted medians along the widest metadata dimension.

The tree is grown level by level. A level needs the extent of each node's dimensions and, for the cut, sums of
weights in a fixed number of ranges of the chosen dimension, refined until one value is left; ties go on by the
row key. Every pass is one aggregate with partial sums, and the driver sees at most nodes x RANGES sums.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

#: Ranges by which a pass narrows a cut down.
RANGES = 1024
#: Rows of a shard that are numbered in one task.
NUMBERED = 50_000


@dataclass
class Node:
    """Shards [first, first + n); the rest is what the search for the cut knows so far."""

    first: int
    n: int
    weight: int = 0
    extent: list = field(default_factory=list)  # (least, most) of each dimension, the key last
    dim: int = 0
    low: int = 0
    high: int = 0
    below: int = 0  # weight under low
    value: int | None = None  # of the dimension, where the cut goes through one value of it
    cut: tuple | None = None  # (dim, value, key): rows below that pair go left


def _of(values: list, kind: str, node: Column) -> Column:
    """The value of a row's node."""
    return F.get(F.array(*(F.lit(v).cast(kind) for v in values)), node)


def _pick(xs: list[Column], dim: Column) -> Column:
    """The column that dim numbers."""
    got = xs[-1]
    for j, x in enumerate(xs[:-1]):
        got = F.when(dim == j, x).otherwise(got)
    return got


def _narrow(node: Node, sums: list[tuple[int, int]], step: int, n_dims: int) -> None:
    """Take the range that holds the target; end at the boundary nearest to it."""
    target = node.weight * (node.n // 2) // node.n
    at, below = 0, node.below
    for at, w in sorted(sums):
        if below + w > target:
            break
        below += w
    w = dict(sums).get(at, 0)
    low = node.low + at * step
    node.below, node.low, node.high = below, low, min(low + step - 1, node.high)
    if step > 1:
        return
    if node.dim < n_dims and node.value is None:
        node.value, (node.low, node.high) = low, node.extent[-1]
        return
    up = low + (target - below > below + w - target)
    node.cut = (node.dim, node.value, up)


def kd_tree(rows: DataFrame, dims: list[str], weight: str, key: str, shards: int) -> DataFrame:
    """rows with their `shard`; the weights of shards are equal but for a few rows'. Whole-number columns without nulls.

    A node's number is that of its first shard. After each level the rows are cut with the node they are in.
    """
    d, k, node = [F.col(x) for x in dims], F.col(key), F.col("node")
    nodes = [Node(0, shards)]
    whole = None
    rows = rows.withColumn("node", F.lit(0))
    while open_ := [x for x in nodes if x.n > 1]:
        of = lambda get, kind, among: _of([get(x) if (x := {y.first: y for y in among}.get(i)) else None for i in range(shards)], kind, node)
        seen = {r[0]: r for r in rows.groupBy("node").agg(F.sum(weight), *(f(x) for x in [*dims, key] for f in (F.min, F.max))).collect()}
        open_ = [x for x in open_ if x.first in seen]  # a node without rows leaves its shards empty
        for x in open_:
            r = seen[x.first]
            x.weight, x.extent = r[1], [(r[2 + 2 * j], r[3 + 2 * j]) for j in range(len(dims) + 1)]
            whole = whole or x.extent
            wide = [(b - a) / max(1, whole[j][1] - whole[j][0]) for j, (a, b) in enumerate(x.extent[:-1])]
            x.dim = wide.index(max(wide)) if wide and max(wide) > 0 else len(dims)
            x.low, x.high = x.extent[x.dim]
        while seek := [x for x in open_ if x.cut is None]:
            step = {x.first: -(-(x.high - x.low + 1) // RANGES) for x in seek}
            chosen = _pick([*d, k], of(lambda x: x.dim, "int", seek))
            value = of(lambda x: x.value, "long", seek)
            now = rows.withColumns({"chosen": chosen, "value": value}).select(
                "node", weight, F.when(F.col("value").isNull(), F.col("chosen")).otherwise(k).alias("x"), of(lambda x: x.low, "long", seek).alias("low"),
                of(lambda x: x.high, "long", seek).alias("high"), of(lambda x: step[x.first], "long", seek).alias("step"), (F.col("value").isNull() | (F.col("value") == F.col("chosen"))).alias("here"),
            ).where("here and x between low and high")
            sums: dict[int, list] = {}
            for n, s, w in now.groupBy("node", F.expr("(x - low) div step").alias("spot")).agg(F.sum(weight)).collect():
                sums.setdefault(n, []).append((s, w))
            for x in seek:
                _narrow(x, sums.get(x.first, []), step[x.first], len(dims))
        x, at = F.col("x"), of(lambda x: x.cut[2], "long", open_)
        value, dim = of(lambda x: x.cut[1], "long", open_), of(lambda x: x.cut[0], "int", open_)
        right = of(lambda x: x.first + x.n // 2, "int", open_)
        moved = rows.withColumns({"x": _pick([*d, k], dim), "value": value, "at": at, "right": right})
        left = F.when(F.col("value").isNull(), x < F.col("at")).otherwise((x < F.col("value")) | ((x == F.col("value")) & (k < F.col("at"))))
        rows = cut(moved.withColumn("node", F.when(F.col("right").isNull() | left, node).otherwise(F.col("right"))).drop("x", "value", "at", "right"))
        nodes = [y for x in nodes if x.n > 1 for y in (Node(x.first, x.n // 2), Node(x.first + x.n // 2, x.n - x.n // 2)) if y.n > 1 and x in open_]
    return rows.withColumnRenamed("node", "shard")


def shard(docs: DataFrame, dims: dict[str, Column], weight: Column, key: Column, shards: int, keep: dict[str, Column] | None = None) -> DataFrame:
    """Every row of docs with its shard and its slot there: (key, weight, *keep, shard, slot).

    dims are whole-number columns over docs; a null dimension, weight or key counts as 0 for the split. Rows with
    the same dimensions and key stay together; slots go by key, weight and kept columns. An empty table gives no rows. Texts are read once, for a narrow table.
    """
    names = [f"dim_{i}" for i in range(len(dims))]
    zero = lambda c: F.coalesce(c.cast("long"), F.lit(0).cast("long"))
    rows = cut(docs.select(key.alias("key"), weight.cast("long").alias("weight"), *(zero(c).alias(n) for n, c in zip(names, dims.values(), strict=True)), *(c.alias(n) for n, c in (keep or {}).items())))
    plain = rows.withColumns({"w": zero(F.col("weight")), "k": zero(F.col("key"))})
    placed = kd_tree(plain, names, "w", "k", shards)
    total = rows.count()
    groups = max(1, -(-total // (shards * NUMBERED)))
    placed = placed.withColumn("part", F.pmod(F.xxhash64("key"), F.lit(groups)).cast("int"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("n")).select("shard", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    own = Window.partitionBy("shard", "part").orderBy("key", "weight", *(keep or {}))
    return placed.withColumn("own", F.row_number().over(own)).join(offsets, ["shard", "part"]).select(
        "key", "weight", *(keep or {}), "shard", (F.col("offset") + F.col("own") - 1).cast("long").alias("slot")
    )
