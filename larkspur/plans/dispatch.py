"""Period dispatch: which plants run, and how much, so that output meets demand at least cost.

Once it is known which plants run, the cheapest output is plain: all at their minimum, and the rest filled in
the order of unit costs. So the search is over sets of running plants. It decides a few plants at a time for all
periods together: the sets begun so far are rows, which spread over the cluster, and a set goes out when no
completion of it can beat the best set known for its period.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.session import saved

AT_ONCE = 6  # plants decided per round
WHOLE = ("byte", "short", "integer", "long")
AMOUNT = "decimal(30,9)"  # sums of fractional outputs do not depend on their order
COLUMNS = ("min_output", "max_output", "unit_cost", "fixed_cost")


def _types(plants: DataFrame, demand: DataFrame) -> tuple[str, str]:
    """Types of amounts and of costs: long where all is whole."""
    kinds = {c: plants.schema[c].dataType.typeName() for c in COLUMNS} | {"demand": demand.schema["demand"].dataType.typeName()}
    amounts = all(kinds[c] in WHOLE for c in ("min_output", "max_output", "demand"))
    costs = amounts and all(kinds[c] in WHOLE for c in ("unit_cost", "fixed_cost"))
    return "long" if amounts else AMOUNT, "long" if costs else "double"


def _periods(plants: DataFrame, demand: DataFrame) -> DataFrame:
    """A row per period: its plants in the order of unit costs, and ``steps``, its output by rising
    price: what a running plant can add to its minimum, at its unit cost, and what a plant not yet
    decided could give if its fixed cost were spread over its output."""
    amount, cost = _types(plants, demand)
    plant = F.struct(
        F.col("unit_cost").cast(cost).alias("unit_cost"),
        F.col("plant").alias("plant"),
        F.col("min_output").cast(amount).alias("lo"),
        F.col("max_output").cast(amount).alias("hi"),
        F.col("fixed_cost").cast(cost).alias("fixed"),
    )
    per = plants.groupBy("period").agg(F.array_sort(F.collect_list(plant)).alias("plants"))
    per = demand.select("period", F.col("demand").cast(amount).alias("demand")).join(per, "period", "left")
    per = per.withColumn("plants", F.coalesce("plants", F.array().cast(per.schema["plants"].dataType)))
    more = lambda p: F.when(p["hi"] > 0, p["fixed"] / p["hi"].cast("double")).otherwise(0.0)
    step = lambda price, i, open_, size: F.struct(price.alias("price"), i.alias("i"), F.lit(open_).alias("open"), size.cast(amount).alias("size"))
    running = F.transform("plants", lambda p, i: step(p["unit_cost"].cast("double"), i, False, p["hi"] - p["lo"]))
    undecided = F.transform("plants", lambda p, i: step(p["unit_cost"].cast("double") + more(p), i, True, p["hi"]))
    return per.withColumn("steps", F.array_sort(F.concat(running, undecided)))


def _filled(steps: Column, rest: Column, fits, amount: str) -> Column:
    """(rest, cost): the rest of the demand filled with the fitting steps, cheapest first."""

    def one(s: Column, p: Column) -> Column:
        take = F.when(fits(p), F.least(p["size"], s["rest"])).otherwise(F.lit(0).cast(amount))
        return F.struct((s["rest"] - take).cast(amount).alias("rest"), (s["cost"] + take.cast("double") * p["price"]).alias("cost"))

    return F.aggregate(steps, F.struct(rest.cast(amount).alias("rest"), F.lit(0.0).alias("cost")), one)


def _sums(plants: Column, on: Column, amount: str) -> Column:
    """(lo, hi, cost) of the running plants at their minimum; ``on`` may be shorter than ``plants``."""
    zero = F.lit(0).cast(amount)
    begin = F.struct(F.lit(0).alias("i"), zero.alias("lo"), zero.alias("hi"), F.lit(0.0).alias("cost"))

    def one(s: Column, p: Column) -> Column:
        runs = F.coalesce(F.get(on, s["i"]), F.lit(False))
        return F.struct(
            (s["i"] + 1).alias("i"),
            (s["lo"] + F.when(runs, p["lo"]).otherwise(zero)).cast(amount).alias("lo"),
            (s["hi"] + F.when(runs, p["hi"]).otherwise(zero)).cast(amount).alias("hi"),
            (s["cost"] + F.when(runs, p["fixed"] + p["lo"].cast("double") * p["unit_cost"]).otherwise(0.0)).alias("cost"),
        )

    return F.aggregate(plants, begin, one)


def _valued(sets: DataFrame, amount: str) -> DataFrame:
    """Adds to (plants, steps, demand, on): ``cost`` if no further plant ran (null if that cannot meet the
    demand), and ``bound``, which no completion of the set can go below (null if none can meet it)."""
    decided = F.size("on")
    mine = lambda p: F.coalesce(F.get(F.col("on"), p["i"]), F.lit(False)) & ~p["open"]
    sets = sets.withColumn("s", _sums(F.col("plants"), F.col("on"), amount))
    rest = F.col("demand") - F.col("s.lo")
    sets = sets.withColumn("alone", _filled(F.col("steps"), rest, mine, amount))
    sets = sets.withColumn("best", _filled(F.col("steps"), rest, lambda p: mine(p) | (p["open"] & (p["i"] >= decided)), amount))
    value = lambda c: F.when((rest >= 0) & (F.col(f"{c}.rest") == 0), F.col("s.cost") + F.col(f"{c}.cost"))
    return sets.withColumns({"cost": value("alone"), "bound": value("best")}).drop("s", "alone", "best")


def _number(on: Column, n: Column) -> Column:
    """The set as digits from the last plant to the first: sorts like the number whose bits they are."""
    return F.reverse(F.concat(on, F.array_repeat(F.lit(False), n - F.size(on))))


def _solved(plants: DataFrame, demand: DataFrame, at_once: int = AT_ONCE) -> DataFrame:
    """(period, demand, plants, cost, on) with the cheapest set of every period, a lower set number on a tie;
    null cost where no set meets the demand."""
    amount, _ = _types(plants, demand)
    per = saved(_periods(plants, demand), "dispatch-periods")
    n = F.size("plants")
    left = -(-(per.agg(F.max(n)).first()[0] or 0) // at_once) or 1  # rounds to go
    best = F.min(F.struct("cost", "number")).alias("b")
    # first guesses: the plants of the lowest spread prices, as many as it takes and more; a single round needs none
    order = F.transform(F.filter("steps", lambda p: p["open"]), lambda p: p["i"])
    first = lambda m: F.transform("plants", lambda p, i: F.array_contains(F.slice(order, 1, m), i))
    guesses = per.select("*", F.explode(F.transform(F.sequence(F.lit(0), n if left > 1 else F.lit(0)), first)).alias("on"))
    known = _valued(guesses, amount).where("cost IS NOT NULL").select("period", "cost", _number(F.col("on"), n).alias("number"))
    known = known.groupBy("period").agg(best).select("period", "b.*")
    if left > 1:
        known = saved(known, "dispatch-best")
    open_ = per.select("period", F.array().cast("array<boolean>").alias("on"))
    while True:
        rows = open_.join(per, "period")
        width = F.least(F.lit(at_once), n - F.size("on"))
        bits = lambda k: F.transform(F.sequence(F.lit(0), width - 1), lambda i: F.call_function("shiftright", k, i).bitwiseAND(1) == 1)
        ways = F.transform(F.sequence(F.lit(0), F.call_function("shiftleft", F.lit(1), width) - 1), lambda k: F.concat("on", bits(k)))
        rows = rows.where(F.size("on") < n).withColumn("on", F.explode(ways))
        rows = _valued(rows, amount).where("bound IS NOT NULL")
        rows = saved(rows.select("period", "on", "cost", "bound", n.alias("n"), _number(F.col("on"), n).alias("number")), "dispatch-sets")
        found = rows.where("cost IS NOT NULL").select("period", "cost", "number").unionByName(known)
        known = saved(found.groupBy("period").agg(best).select("period", "b.*"), "dispatch-best")
        left -= 1
        if not left:
            return per.select("period", "demand", "plants").join(known, "period", "left").withColumn("on", F.reverse("number"))
        # a set that is as cheap may still have a lower number; the margin is that of rounding
        worth = F.col("least").isNull() | (F.col("bound") <= F.col("least") + F.abs("least") * 1e-12)
        kept = rows.where(F.size("on") < F.col("n")).join(known.select("period", F.col("cost").alias("least")), "period", "left")
        open_ = saved(kept.where(worth).select("period", "on"), "dispatch-open")


def dispatch(plants: DataFrame, demand: DataFrame) -> DataFrame:
    """(period, plant, output, running, unit_cost, fixed_cost, period_cost).

    ``plants`` has period, plant, min_output, max_output, unit_cost and fixed_cost, ``demand`` period and demand; whole
    numbers or fractions, not negative. A running plant gives between its minimum and maximum, a resting one
    nothing; output equals demand. The cheapest set of running plants wins, on a tie the one with the
    lower number, whose bits follow the order of unit costs. Periods that no set can meet have no rows
    here; ``status`` tells them.
    """
    amount, cost = _types(plants, demand)
    solved = _solved(plants, demand).where("cost IS NOT NULL")
    rest = F.col("demand") - _sums(F.col("plants"), F.col("on"), amount)["lo"]
    zero = F.lit(0).cast(amount)

    def give(s: Column, p: Column) -> Column:
        runs = F.get(F.col("on"), F.size(s["outputs"]))
        extra = F.when(runs, F.least(p["hi"] - p["lo"], s["rest"])).otherwise(zero)
        out = F.when(runs, p["lo"] + extra).otherwise(zero).cast(amount)
        return F.struct((s["rest"] - extra).cast(amount).alias("rest"), F.concat(s["outputs"], F.array(out)).alias("outputs"))

    begin = F.struct(rest.cast(amount).alias("rest"), F.array().cast(f"array<{amount}>").alias("outputs"))
    solved = solved.withColumn("outputs", F.aggregate("plants", begin, give)["outputs"])
    shown = "long" if amount == "long" else "double"
    plant = F.col("plants")[F.col("i")]
    return solved.select("period", "cost", "plants", "on", F.posexplode("outputs").alias("i", "output")).select(
        "period",
        plant["plant"].alias("plant"),
        F.col("output").cast(shown).alias("output"),
        F.col("on")[F.col("i")].cast("int").alias("running"),
        plant["unit_cost"].alias("unit_cost"),
        plant["fixed"].alias("fixed_cost"),
        F.col("cost").cast(cost).alias("period_cost"),
    )


def status(plants: DataFrame, demand: DataFrame) -> DataFrame:
    """(period, status, period_cost) of every period with a demand: ``optimal`` or ``infeasible``."""
    _, cost = _types(plants, demand)
    told = F.when(F.col("cost").isNull(), "infeasible").otherwise("optimal")
    return _solved(plants, demand).select("period", told.alias("status"), F.col("cost").cast(cost).alias("period_cost"))
