"""Greedy knapsack over many instances: items in order, each taken if it fits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larkspur.operators.joins import sliced_join
from larkspur.session import materialise

# Items of an instance that one array may hold, and items per block of a larger one.
ARRAY_ITEMS = 50_000
BLOCK = 2_000
HOT_SHARE = 1e-3


def _fold(items: Column, room: Column, weight: str) -> Column:
    """Run the items through the remaining room, keeping a flag per item."""
    start = F.struct(room.cast(weight).alias("room"), F.array().cast("array<boolean>").alias("taken"))
    return F.aggregate(
        items,
        start,
        lambda s, i: F.struct(
            F.when(i["weight"] <= s["room"], (s["room"] - i["weight"]).cast(weight)).otherwise(s["room"]).alias("room"),
            F.concat(s["taken"], F.array(i["weight"] <= s["room"])).alias("taken"),
        ),
    )


def _fold_totals(items: Column, room: Column, value: str, weight: str) -> Column:
    zero = F.lit(0)
    start = F.struct(room.cast(weight).alias("room"), zero.cast(value).alias("value"), zero.cast("long").alias("n"))
    return F.aggregate(
        items,
        start,
        lambda s, i: F.when(
            i["weight"] <= s["room"],
            F.struct(
                (s["room"] - i["weight"]).cast(weight).alias("room"),
                (s["value"] + i["value"]).cast(value).alias("value"),
                (s["n"] + 1).alias("n"),
            ),
        ).otherwise(s),
    )


EXACT = "decimal(38,12)"


def _exact(items: DataFrame) -> DataFrame:
    """Whole numbers as long; fractions, in which a capacity may be met exactly, as decimals: their sums do
    not depend on the order of adding, so an instance gives the same in one array and in blocks."""
    kinds = {c: items.schema[c].dataType.typeName() for c in ("value", "weight", "capacity")}
    whole = lambda c: kinds[c] in ("byte", "short", "integer", "long")
    size = "long" if whole("weight") and whole("capacity") else EXACT
    to = {"value": "long" if whole("value") else EXACT, "weight": size, "capacity": size}
    return items.withColumns({c: F.col(c).cast(t) for c, t in to.items()})


def _packed(items: DataFrame, keys: list[str]) -> DataFrame:
    """Ordered item array per key; callers see to it that a key has few items."""
    entry = F.struct("item", "value", "weight")
    return items.groupBy(*keys).agg(F.array_sort(F.collect_list(entry)).alias("items"))


def _type(items: DataFrame, column: str) -> str:
    return items.schema[column].dataType.simpleString()


def oversized(items: DataFrame, array_items: int) -> DataFrame:
    """Instances with more items than one array may hold; at most rows/array_items."""
    sizes = items.groupBy("instance").agg(F.count("*").alias("n"), F.max("capacity").alias("capacity"))
    return sizes.where(F.col("n") > array_items)


def _greedy_small(items: DataFrame) -> DataFrame:
    return (
        _packed(items, ["instance", "capacity"])
        .withColumn("s", _fold_totals(F.col("items"), F.col("capacity"), _type(items, "value"), _type(items, "weight")))
        .select(
            "instance",
            "capacity",
            F.col("s.value").alias("value"),
            (F.col("capacity") - F.col("s.room")).alias("weight"),
            F.col("s.n").alias("taken"),
        )
    )


def greedy(items: DataFrame, array_items: int = ARRAY_ITEMS, block: int = BLOCK) -> DataFrame:
    """(instance, capacity, value, weight, taken) of the greedy choice.

    ``items`` has instance, item (unique order within the instance), value, weight
    (positive) and capacity, whole numbers or fractions; sums come back in the types of the columns. Instances of at most
    ``array_items`` items are folded as one array. Larger ones are solved exactly in blocks, see
    ``greedy_large``, with the same result.
    """
    types = {"capacity": _type(items, "capacity"), "value": _sum_type(items, "value"), "weight": _sum_type(items, "weight")}
    out = _greedy(_exact(items), array_items, block)
    return out.withColumns({c: F.col(c).cast(t) for c, t in types.items()})


def _sum_type(items: DataFrame, column: str) -> str:
    return {"tinyint": "bigint", "smallint": "bigint", "int": "bigint", "float": "double"}.get(_type(items, column), _type(items, column))


def _greedy(items: DataFrame, array_items: int, block: int) -> DataFrame:
    big = oversized(items, array_items)
    if big.isEmpty():
        return _greedy_small(items)
    big = materialise(big)
    # At most 1/HOT_SHARE instances are that large, whatever the number of items.
    limit = F.greatest(F.ceil(items.agg(F.count("*")).scalar() * HOT_SHARE), F.lit(2))
    hot = big.where(F.col("n") >= limit).select("instance", F.ceil(F.col("n") / limit).cast("int").alias("__slices"))
    marked = sliced_join(
        items,
        big.select("instance", F.lit(1).alias("is_big")),
        ["instance"],
        F.col("item"),
        how="left",
        hot=hot,
    )
    small = _greedy_small(marked.where(F.col("is_big").isNull()).drop("is_big"))
    flags = greedy_large(marked.where(F.col("is_big") == 1).drop("is_big"), block)
    won = F.col("chosen")
    sums = flags.groupBy("instance").agg(
        F.sum(F.when(won, F.col("value")).otherwise(0)).alias("value"),
        F.sum(F.when(won, F.col("weight")).otherwise(0)).alias("weight"),
        F.sum(won.cast("long")).alias("taken"),
    )
    # An instance in which nothing fits has no settled item, but is a result.
    large = big.select("instance", "capacity").join(sums, "instance", "left").na.fill(0)
    return small.unionByName(large)


def greedy_large(items: DataFrame, block: int = BLOCK) -> DataFrame:
    """Settled items with their flag, for instances too large for one array.

    Items are dealt into blocks of consecutive order. In a round, items heavier
    than the room left can never be taken and go out. The weights of the rest are
    summed per block: all blocks before the one where the running sum exceeds the
    room are taken whole, and that one block is folded item by item. The room is
    then smaller than the item that overflowed, so a round settles at least one
    block and usually nearly all of them. A round is a few distributed passes; every
    join is on (instance, block), so no task holds more than a block of an instance.
    """
    items = _exact(items)
    size = _type(items, "weight")
    rows = materialise(_with_blocks(items, block))
    blocks = materialise(rows.groupBy("instance", "block").agg(F.max("capacity").alias("capacity")))
    room = blocks.groupBy("instance").agg(F.max("capacity").alias("room"), F.lit(-1).cast("long").alias("done"))
    settled: list[DataFrame] = []
    while True:
        ahead = blocks.drop("capacity").join(room, "instance").where(F.col("block") > F.col("done"))
        fitting = rows.join(ahead, ["instance", "block"]).where(F.col("weight") <= F.col("room"))
        sums = fitting.groupBy("instance", "block", "room").agg(F.sum("weight").cast(size).alias("w"))
        upto = F.sum("w").over(Window.partitionBy("instance").orderBy("block")).cast(size)
        over = F.col("upto") > F.col("room")
        of_instance = Window.partitionBy("instance")
        edge = F.min(F.when(over, F.col("block"))).over(of_instance)
        used = F.max(F.when(~over, F.col("upto"))).over(of_instance)
        state = materialise(
            sums.withColumn("upto", upto).select(
                "instance",
                "block",
                "room",
                edge.alias("edge"),
                (F.col("room") - F.coalesce(used, F.lit(0))).cast(size).alias("before"),
                F.max("block").over(of_instance).alias("last"),
            )
        )
        if state.isEmpty():
            break
        current = rows.join(state, ["instance", "block"]).where(F.col("weight") <= F.col("room"))
        settled.append(
            current.where(F.col("edge").isNull() | (F.col("block") < F.col("edge"))).select(
                "instance", "item", "value", "weight", "capacity", F.lit(True).alias("chosen")
            )
        )
        folded = materialise(
            _packed(current.where(F.col("block") == F.col("edge")), ["instance", "before", "edge", "capacity"]).withColumn(
                "s", _fold(F.col("items"), F.col("before"), size)
            )
        )
        pairs = F.explode(F.zip_with("items", "s.taken", lambda i, t: F.struct(i.alias("i"), t.alias("chosen"))))
        settled.append(
            folded.select("instance", "capacity", pairs.alias("z")).select(
                "instance",
                F.col("z.i.item").alias("item"),
                F.col("z.i.value").alias("value"),
                F.col("z.i.weight").alias("weight"),
                "capacity",
                F.col("z.chosen").alias("chosen"),
            )
        )
        room = materialise(
            state.select("instance", "before", "edge", "last")
            .distinct()
            .join(folded.select("instance", F.col("s.room").alias("left")), "instance", "left")
            .select("instance", F.coalesce("left", "before").alias("room"), F.coalesce("edge", "last").alias("done"))
        )
    columns = ["instance", "item", "value", "weight", "capacity"]
    out = rows.select(*columns, F.lit(False).alias("chosen")).limit(0)
    for part in settled:
        out = out.unionByName(part)
    return out


def _with_blocks(items: DataFrame, block: int) -> DataFrame:
    """Number blocks of consecutive items. Range partitions hold consecutive items
    of an instance; within one, every ``block`` items make a block."""
    parts = max(1, -(-items.count() // ARRAY_ITEMS))
    spread = items.repartitionByRange(parts, "instance", "item").withColumn("part", F.spark_partition_id().cast("long"))
    place = F.row_number().over(Window.partitionBy("instance", "part").orderBy("item")) - 1
    numbered = materialise(spread).withColumn("block", F.col("part") * 1_000_000 + F.floor(place / block))
    return numbered.drop("part")
