"""Sharding by a k-d tree: split at weighted medians along the widest metadata dimension."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from silverline.llm.common import materialise, running_total

#: Bits of a coordinate, and of the text hash that breaks its ties, in one sorting key.
COORD_BITS, TIE_BITS = 16, 46
#: Cells that a node's range is divided into to find the one that holds its median.
CELLS = 1024


def size_of(text) -> Column:
    """UTF-8 bytes plus eight for the row itself; a null text has none."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 8


def _is_text(docs: DataFrame, name: str) -> bool:
    return isinstance(docs.schema[name].dataType, StringType)


def _ranked(groups: DataFrame, name: str) -> DataFrame:
    """Turn a string column into the dense rank of its values from 0, however many there are; null stays null."""
    values = materialise(groups.where(F.col(name).isNotNull()).select(F.col(name).alias("value")).distinct(), "values")
    ranks = running_total(values.withColumn("one", F.lit(1)), [], ["value"], "one", "rank").select("value", "rank")
    ranked = groups.join(ranks, F.col(name) == F.col("value"), "left")
    return ranked.withColumn(name, F.col("rank").cast("double")).drop("value", "rank")


def kd_tree_shards(
    docs: DataFrame,
    *,
    leaves: int | None = None,
    target_bytes: int | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    dims: tuple[str, ...] = ("source", "lang"),
) -> DataFrame:
    """Deal documents into shards of near equal bytes that are compact in their metadata.

    Returns, for each row: the id column, `size` (bytes of the text plus 8), `text_crc32` (null for a null
    text), `shard` from 0 and `slot`, gapless from 0 in each shard in an order set by the id.

    Documents with equal texts form a group and share a shard, null texts too. A group's coordinates are the
    logarithm of its text's size and the smallest value of each column of `dims` and of the id, scaled to 16
    bits; strings count as the dense rank of their values. Every node is cut along its widest coordinate where the bytes come nearest to the share of
    its left leaves; ties in a coordinate are cut by text hash, so no tie can unbalance a cut. The
    leaves are then shared by what each side really weighs. `leaves` gives their number,
    otherwise they follow from `target_bytes`. A group heavier than an even share gets a
    shard of its own. Null ids and metadata sort first; a table without rows gives none; equal rows stay
    separate rows; other columns are ignored.

    The tree is a table of open nodes and stays in Spark, so the driver sees one row a level, however many shards there are. A
    level finds all its medians at once: sums over CELLS cells of each node's range tell the cell that holds the median, and a
    running sum over the keys in that cell, spread over tasks, tells the cut. The points are stored with their node once a level.
    """
    if (leaves is None) == (target_bytes is None):
        raise ValueError("give either leaves or target_bytes")
    rows = materialise(
        docs.select(
            F.col(id_col).alias("id"),
            size_of(F.col(text_col)).alias("size"),
            F.crc32(F.encode(F.col(text_col), "utf-8")).alias("crc"),
            F.xxhash64(F.col(text_col), F.col(text_col).isNull()).alias("h"),
            F.xxhash64(F.lit(7), F.col(text_col)).alias("g"),
            *((F.col(d) if _is_text(docs, d) else F.col(d).cast("double")).alias(f"m{i}") for i, d in enumerate(dims)),
        ),
        "sizes",
    )
    metas = [f"m{i}" for i in range(len(dims))]
    groups = rows.groupBy("h", "g").agg(
        F.sum("size").alias("weight"),
        F.log2(F.max("size")).alias("x0"),
        F.min("id").cast("double").alias("x1"),
        *(F.min(m).alias(f"x{i + 2}") for i, m in enumerate(metas)),
    )
    xs = [f"x{i}" for i in range(len(dims) + 2)]
    texts = [x for x, d in zip(xs[2:], dims) if _is_text(docs, d)]
    if texts:
        groups = materialise(groups, "grouped")
    for x in texts:
        groups = _ranked(groups, x)
    groups = materialise(groups.select("h", "g", "weight", *(F.coalesce(x, F.lit(-1.0)).alias(x) for x in xs)), "groups")
    total = groups.agg(
        F.count("*"), F.sum("weight"), *(F.min(x) for x in xs), *(F.max(x) for x in xs)
    ).first()
    count, weight = total[0], total[1] or 0
    if leaves is None:
        leaves = max(1, -(-weight // target_bytes))
    low, high = total[2 : 2 + len(xs)], total[2 + len(xs) :]
    top = (1 << COORD_BITS) - 1
    scaled = [
        (F.floor((F.col(x) - lo) / (hi - lo) * top) if count and hi > lo else F.lit(0)).cast("int")
        for x, lo, hi in zip(xs, low, high)
    ]
    points = materialise(
        groups.select(
            "h", "g", "weight", F.array(*scaled).alias("c"), F.shiftrightunsigned("g", 64 - TIE_BITS).alias("tie")
        ),
        "points",
    )
    bound, heavy = _bound(points, leaves, weight)
    light = points
    if heavy:
        alone = materialise(points.where(F.col("weight") > bound).select("h", "g", (-F.col("weight")).alias("order"), F.lit(1).alias("one")), "alone")
        alone = running_total(alone, [], ["order", "h", "g"], "one", "rank")
        alone = alone.select("h", "g", (F.col("rank") + (leaves - heavy)).cast("int").alias("shard"))
        light = points.where(F.col("weight") <= bound)
    placed = _grow(light, leaves - heavy, len(xs))
    if heavy:
        placed = placed.union(alone)
    out = rows.select("id", "size", "crc", "h", "g").join(placed, ["h", "g"]).select("id", "size", "crc", "shard")
    out = materialise(out.select("*", F.xxhash64("id").alias("mixed"), F.lit(1).alias("one")), "placed")
    out = running_total(out, ["shard"], ["mixed", "id", "crc", "size"], "one", "slot")
    return out.select(
        F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), "shard", "slot"
    )


def _bound(points: DataFrame, leaves: int, weight: int) -> tuple[float, int]:
    """The weight beyond which a group gets a shard of its own, and how many do: those that weigh more than an even
    share of what lighter ones leave, always fewer than there are leaves."""
    heavy, taken = 0, 0
    while True:
        bound = (weight - taken) / (leaves - heavy)
        n, w = points.where(F.col("weight") > bound).agg(F.count("*"), F.sum("weight")).first()
        if n == heavy:
            return bound, heavy
        heavy, taken = n, w


def _key(dim) -> Column:
    """The sorting key of a point along one coordinate."""
    coord = F.get(F.col("c"), dim).cast("long")
    return F.shiftleft(coord, TIE_BITS) + F.col("tie")


def _grow(points: DataFrame, leaves: int, dims: int) -> DataFrame:
    """Cut the points (h, g, weight, c, tie) into `leaves` shards: (h, g, shard), numbered from left to right.

    A node is named by the first of its leaves. It becomes a leaf if one leaf or one point is left, or no cut leaves both sides a point.
    """
    spark, done = points.sparkSession, []
    points = points.withColumn("node", F.lit(0).cast("long"))
    nodes = spark.range(1).select(F.col("id").alias("node"), F.lit(leaves).cast("long").alias("leaves"))
    while leaves > 1:
        cuts = materialise(_shared(_cuts(points, nodes, dims)), "shares")
        moves = cuts.select("node", "dim", "cut", F.struct("low.child", "low.open").alias("low"), F.struct("high.child", "high.open").alias("high"))
        side = F.when(F.col("cut").isNotNull(), F.when(_key(F.col("dim")) >= F.col("cut"), F.col("high")).otherwise(F.col("low")))
        moved = points.join(moves, "node", "left").select("h", "g", "weight", "c", "tie", "node", side.alias("side"))
        moved = moved.withColumn("node", F.coalesce("side.child", "node")).withColumn("open", F.coalesce("side.open", F.lit(False)))
        # stored, as the next level reads its points four times
        moved = materialise(moved.drop("side"), "moved")
        done.append(moved.where("not open").select("h", "g", "node"))
        points = moved.where("open").drop("open")
        nodes = cuts.select(F.explode(F.array("low", "high")).alias("s")).where("s.open").select(F.col("s.child").alias("node"), "s.leaves")
        if nodes.isEmpty():
            break
    placed = reduce(DataFrame.union, done) if done else points.select("h", "g", "node")
    placed = materialise(placed, "leaves")
    numbers = materialise(placed.select("node").distinct().withColumn("one", F.lit(1)), "numbers")
    numbers = running_total(numbers, [], ["node"], "one", "shard").select("node", F.col("shard").cast("int").alias("shard"))
    return placed.join(numbers, "node").select("h", "g", "shard")


def _cuts(points: DataFrame, nodes: DataFrame, dims: int) -> DataFrame:
    """Where to cut each node: (node, leaves, weight, n, dim, cut, left, m), `left` and `m` being the weight and the points below the cut.

    The cut is the key, along the widest coordinate, below which the weight comes nearest to the share of half of the
    leaves; of two as near, the lower. Nodes whose points agree in the key have none.
    """
    boxes = points.groupBy("node").agg(
        F.sum("weight").alias("weight"),
        F.count("*").alias("n"),
        F.array(*(F.min(F.get("c", F.lit(d))) for d in range(dims))).alias("low"),
        F.array(*(F.max(F.get("c", F.lit(d))) for d in range(dims))).alias("high"),
    )
    widths = F.zip_with("low", "high", lambda a, b: b - a)
    boxes = boxes.join(nodes, "node").withColumn("dim", (F.array_position(widths, F.array_max(widths)) - 1).cast("int"))
    low = F.shiftleft(F.get("low", F.col("dim")).cast("long"), TIE_BITS)
    high = F.shiftleft(F.get("high", F.col("dim")).cast("long") + 1, TIE_BITS)
    boxes = boxes.withColumns({"low": low, "high": high, "want": F.col("weight").cast("double") * F.expr("leaves div 2") / F.col("leaves")})
    boxes = boxes.withColumn("step", F.expr(f"(high - low + {CELLS - 1}) div {CELLS}")).drop("high")
    boxes = materialise(boxes, "boxes")

    keyed = points.select("node", F.col("weight").alias("w"), "c", "tie")
    cells = keyed.join(boxes, "node").select("node", "w", _key(F.col("dim")).alias("key"), "low", "step")
    cells = cells.groupBy("node", F.expr("(key - low) div step").alias("cell")).agg(F.sum("w").alias("w"), F.count("*").alias("rows"))
    # At most CELLS rows a node.
    ahead = Window.partitionBy("node").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.withColumns({"before": F.coalesce(F.sum("w").over(ahead), F.lit(0)), "rows": F.coalesce(F.sum("rows").over(ahead), F.lit(0))})
    held = cells.join(boxes, "node").where("before < want and before + w >= want")
    held = held.withColumn("low", F.expr("low + cell * step")).withColumn("high", F.expr("low + step"))
    held = materialise(held.select("node", "leaves", "weight", "n", "dim", "want", "low", "high", "before", "w", "rows"), "held")

    keys = keyed.join(held.select("node", "dim", "low", "high"), "node").withColumn("key", _key(F.col("dim")))
    keys = keys.where("key >= low and key < high").groupBy("node", "key").agg(F.sum("w").alias("w"), F.count("*").alias("points"))
    keys = materialise(keys, "keys")
    sums = running_total(keys, ["node"], ["key"], "w", "inside").select("node", F.col("key").alias("cut"), "inside")
    tried = sums.join(held, "node").withColumn("left", F.col("before") + F.col("inside"))
    names = ["node", "leaves", "weight", "n", "rows", "dim", "want", "cut", "left"]
    ends = held.withColumn("cut", F.col("high")).withColumn("left", F.col("before") + F.col("w"))
    tried = tried.select(*names).union(ends.select(*names)).where("left > 0 and left < weight")
    best = F.min(F.struct(F.abs(F.col("left") - F.col("want")).alias("off"), "cut", "left")).alias("best")
    found = tried.groupBy("node", "leaves", "weight", "n", "rows", "dim").agg(best).select("*", "best.cut", "best.left").drop("best")
    below = F.sum(F.when(F.col("key") < F.col("cut"), F.col("points")).otherwise(0))
    counted = keys.select("node", "key", "points").join(found, "node").groupBy(*found.columns).agg(below.alias("below"))
    return counted.select("node", "leaves", "weight", "n", "dim", "cut", "left", (F.col("rows") + F.col("below")).alias("m"))


def _shared(cuts: DataFrame) -> DataFrame:
    """The cuts (node, dim, cut) with both children, `low` and `high`: (child, leaves, open). The leaves are shared by what each side weighs,
    but no side gets more than it has points."""
    even = F.bround(F.col("leaves") * F.col("left").cast("double") / F.col("weight"), 0).cast("long")
    within = lambda x: F.least(F.greatest(F.lit(1), x), F.col("leaves") - 1)
    lower = F.greatest(F.least(within(even), F.col("m")), F.col("leaves") - (F.col("n") - F.col("m")))
    side = lambda child, leaves, n: F.struct(
        child.alias("child"), leaves.alias("leaves"), ((leaves > 1) & (n > 1)).alias("open")
    )
    both, lower = cuts.withColumn("lower", within(lower)), F.col("lower")
    low = side(F.col("node"), lower, F.col("m"))
    high = side(F.col("node") + lower, F.col("leaves") - lower, F.col("n") - F.col("m"))
    return both.select("node", "dim", "cut", low.alias("low"), high.alias("high"))
