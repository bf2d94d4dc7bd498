import itertools
import random

from larkspur.plans.dispatch import dispatch, status

PLANTS = "period string, plant string, min_output long, max_output long, unit_cost long, fixed_cost long"


def cheapest(plants, demand):
    best = None
    for on in itertools.product((0, 1), repeat=len(plants)):
        lo = sum(p[2] for p, o in zip(plants, on) if o)
        hi = sum(p[3] for p, o in zip(plants, on) if o)
        if not lo <= demand <= hi:
            continue
        rest, cost = demand - lo, 0
        for p, o in sorted(zip(plants, on), key=lambda x: x[0][4]):
            if o:
                extra = min(p[3] - p[2], rest)
                rest -= extra
                cost += (p[2] + extra) * p[4] + p[5]
        best = cost if best is None else min(best, cost)
    return best


def run(spark, plants, demand):
    return dispatch(spark.createDataFrame(plants, PLANTS), spark.createDataFrame(demand, "period string, demand long"))


def test_known_months(spark):
    plants = [
        ("01", "A", 20000, 100000, 10, 500),
        ("01", "B", 20000, 50000, 5, 600),
        ("10", "A", 20000, 197000, 10, 500),
        ("10", "B", 20000, 100000, 11, 600),
    ]
    rows = {(r["period"], r["plant"]): r for r in run(spark, plants, [("01", 120000), ("10", 190000)]).collect()}
    assert (rows["01", "A"]["output"], rows["01", "B"]["output"], rows["01", "A"]["period_cost"]) == (70000, 50000, 951100)
    assert (rows["10", "A"]["output"], rows["10", "B"]["running"], rows["10", "A"]["period_cost"]) == (190000, 0, 1900500)


def test_against_enumeration(spark):
    rng = random.Random(3)
    plants, demand = [], []
    for k in range(25):
        for p in range(rng.randint(1, 5)):
            lo = rng.randint(0, 20)
            plants.append((f"m{k:02}", f"p{p}", lo, lo + rng.randint(0, 40), rng.randint(1, 9), rng.randint(0, 50)))
        demand.append((f"m{k:02}", rng.randint(0, 120)))
    out = {}
    for r in run(spark, plants, demand).collect():
        out.setdefault(r["period"], []).append(r)
    for period, need in demand:
        mine = [p for p in plants if p[0] == period]
        want = cheapest(mine, need)
        if want is None:
            assert period not in out
            continue
        assert {r["period_cost"] for r in out[period]} == {want}
        assert sum(r["output"] for r in out[period]) == need


def by_points(plants, demand):
    """Least cost by whole outputs: in an optimum at most one running plant is between its bounds, cheaper ones are at
    their maximum and dearer ones at their minimum."""
    plants = sorted(plants, key=lambda p: p[4])
    none = float("inf")

    def reach(some, side):
        cost = [0] + [none] * demand
        for p in some:
            size, price = p[side], p[5] + p[4] * p[side]
            cost = [min(c, cost[w - size] + price if w >= size else none) for w, c in enumerate(cost)]
        return cost

    best = none if demand else 0
    for m, (_, _, lo, hi, c, f) in enumerate(plants):
        below, above = reach(plants[:m], 3), reach(plants[m + 1 :], 2)
        for out in range(lo, min(hi, demand) + 1):
            rest = demand - out
            best = min([best, *(below[w] + above[rest - w] + f + c * out for w in range(rest + 1))])
    return best


def test_forty_plants(spark):
    rng = random.Random(11)
    plants, demand = [], [("m0", 300), ("m1", 90), ("m2", 10_000)]
    for m, _ in demand:
        for i in range(40):
            lo = rng.randint(1, 12)
            plants.append((m, f"p{i:02}", lo, lo + rng.randint(0, 25), rng.randint(5, 30), rng.randint(20, 200)))
    frames = spark.createDataFrame(plants, PLANTS), spark.createDataFrame(demand, "period string, demand long")
    told = {r["period"]: (r["status"], r["period_cost"]) for r in status(*frames).collect()}
    for m, d in demand[:2]:
        assert told[m] == ("optimal", by_points([p for p in plants if p[0] == m], d))
    assert told["m2"] == ("infeasible", None)
    out = dispatch(*frames).collect()
    assert {r["period"] for r in out} == {"m0", "m1"} and len(out) == 80
    bounds = {(p[0], p[1]): p for p in plants}
    for r in out:
        _, _, lo, hi, _, _ = bounds[r["period"], r["plant"]]
        assert lo <= r["output"] <= hi if r["running"] else r["output"] == 0
    assert {m: sum(r["output"] for r in out if r["period"] == m) for m in ("m0", "m1")} == {"m0": 300, "m1": 90}


def test_fractions_and_infeasible_periods(spark):
    rows = [("a", "x", 2.5, 6.25, 1.5, 3.0), ("a", "y", 0.5, 4.0, 1.25, 10.0), ("b", "x", 2.0, 3.0, 1.0, 1.0)]
    plants = spark.createDataFrame(rows, PLANTS.replace("long", "double"))
    demand = spark.createDataFrame([("a", 6.5), ("b", 1.5), ("c", 0.0), ("d", 0.1)], "period string, demand double")
    got = {(r["period"], r["plant"]): (r["output"], r["running"], r["period_cost"]) for r in dispatch(plants, demand).collect()}
    cost = 4.0 * 1.25 + 10 + 2.5 * 1.5 + 3
    assert got == {("a", "x"): (2.5, 1, cost), ("a", "y"): (4.0, 1, cost)}
    told = {r["period"]: (r["status"], r["period_cost"]) for r in status(plants, demand).collect()}
    assert told == {"a": ("optimal", cost), "b": ("infeasible", None), "c": ("optimal", 0.0), "d": ("infeasible", None)}
