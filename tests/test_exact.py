"""Sums of floating amounts: nothing is lost, and neither order nor partitioning matters."""

from __future__ import annotations

import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, DoubleType

import builders as b
from tallybook.operators.exact import exact, is_zero, plus, shown, summed, total
from tallybook.plans import costs, workspace


def sums(frame, kind=DoubleType()):
    """n, sum as shown, whether it is zero, by key."""
    held = exact(F.col("x"), kind)
    found = frame.groupBy("k").agg(summed(held, True).alias("s"), total(held, True).alias("t"))
    return {r.k: r for r in found.select("k", shown(F.col("s")).alias("s"), shown(F.col("t")).alias("t"), is_zero(F.col("t"), True).alias("zero")).collect()}


def named(x):
    """The decimal number that names a double."""
    return Fraction(repr(x))


def test_sums_are_the_nearest_doubles(spark):
    rng = random.Random(11)
    rows = [(k, rng.choice([-1, 1]) * rng.uniform(1, 10) * 10.0 ** rng.randint(-10, 7)) for k in range(20) for _ in range(60)]
    rows += [(100, 1e-10)] * 5 + [(101, 0.1), (101, 0.2), (101, -0.3)] + [(102, 1e9), (102, 1e-10), (102, -1e9)] + [(103, None)]
    rows += [(104, 3e15), (104, 0.5), (105, -4e-10)] + [(106, 1e-10), (106, None)]
    want = {}
    for k, x in rows:
        want[k] = want.get(k, Fraction(0)) + (named(x) if x is not None else 0)
    for parts in (1, 7):
        rng.shuffle(rows)
        got = sums(spark.createDataFrame(rows, "k int, x double").repartition(parts))
        assert {k: r.t for k, r in got.items()} == {k: float(x) for k, x in want.items()}
        assert {k for k, r in got.items() if r.zero} == {k for k, x in want.items() if x == 0} and got[103].s is None
        assert got[101].zero and got[102].s == 1e-10


@pytest.mark.parametrize("odd", [float("nan"), float("inf"), float("-inf")])
def test_endless_amounts_fail(spark, odd):
    with pytest.raises(Exception, match="not a number"):
        sums(spark.createDataFrame([(1, 2.0), (1, odd)], "k int, x double"))


def test_float_amounts_and_sums_of_sums(spark):
    frame = spark.createDataFrame([(1, 0.1), (1, 0.2)], "k int, x double").withColumn("x", F.col("x").cast("float"))
    assert sums(frame, frame.schema["x"].dataType)[1].s == 0.3
    held = exact(F.col("x"), DoubleType())
    twice = spark.createDataFrame([(1, 2e8 + 1e-7)] * 9, "k int, x double").groupBy("k").agg(total(held, True).alias("s"))
    twice = twice.groupBy().agg(total(F.col("s"), True).alias("s")).select(shown(plus(F.col("s"), F.col("s"), True)).alias("s"))
    assert twice.first().s == float(18 * named(2e8 + 1e-7))


def test_tiny_amounts_reach_the_views(spark):
    """Lines of 1e-10 count, and a margin of as little keeps a group with the first party."""
    line = {"project": None, "credits": [("RESELLER_MARGIN", 0)]}
    export = b.export(spark, *[line] * 5).withColumns({
        "cost": F.lit(1e-10), "customer_cost": F.lit(1e-10),
        "credits": F.transform("credits", lambda c: F.struct(c["type"].alias("type"), F.lit(-4e-10).alias("amount"))),
    })
    (got,) = costs.gcp_costs(export, b.skus(spark), b.maps(spark), b.payers(spark), b.AS_OF).collect()
    assert (got.cost_gcp, got.reseller_margin_gcp, got.cost_thirdparty) == (5e-10, -2e-9, 0.0)


def test_mean_of_seats_ignores_the_order(spark):
    values = [0.1, 0.2, 0.3, 1.4, 1e-10, -1e-10 + 5.5] * 7
    kind = DoubleType()
    found = set()
    for parts in (1, 7):
        for _ in range(3):
            random.shuffle(values)
            frame = spark.createDataFrame([(x,) for x in values], "x double").repartition(parts)
            found.add(frame.agg(workspace._average(F.col("x"), kind)).first()[0])
    assert found == {float(sum(map(named, values))) / len(values)}
    whole = spark.createDataFrame([(2,), (3,)], "x int").select(F.col("x").cast(DecimalType(10, 2)).alias("x"))
    assert float(whole.agg(workspace._average(F.col("x"), whole.schema["x"].dataType)).first()[0]) == 2.5
