"""Exact depth, fees and baskets against Python's decimals."""

import random
from decimal import ROUND_CEILING, ROUND_HALF_UP, Decimal, localcontext

import pytest
from pyspark.sql import functions as F

from ticktide.operators import exact

LEVELS = "k long, n long, price double, size double"


def by_hand(levels, contracts, rate, exponent):
    left, notional, fee = Decimal(contracts), Decimal(0), Decimal(0)
    for _, price, size in sorted((p, p, s) for p, s in levels):
        take = min(left, size)
        notional, left, fee = notional + take * price, left - take, fee + rate * take * (price * (1 - price)) ** exponent
    filled = contracts - left
    return filled, notional, (notional / filled).quantize(Decimal("1e-12"), ROUND_HALF_UP), left > 0, fee, (fee / Decimal("0.0001")).to_integral_value(ROUND_CEILING) * Decimal("0.0001")


@pytest.mark.parametrize("exponent", [0, 1, 2])
def test_walks_equal_decimals(spark, exponent):
    rng, rows, want = random.Random(exponent), [], {}
    with localcontext() as context:
        context.prec = 80
        for k in range(40):
            levels = [(Decimal(rng.randint(1, 9999)) / 10000, Decimal(rng.randint(1, 300_000)) / 10000) for _ in range(rng.randint(1, 9))]
            rows += [(k, i, float(p), float(s)) for i, (p, s) in enumerate(levels)]
            want[k] = by_hand(levels, 100, Decimal("0.07"), exponent)
        out = exact.walk(spark.createDataFrame(rows, LEVELS), ["k"], "price", "size", 100, ["n"], F.lit("0.07").cast("decimal(6,4)"), exponent)
        got = {r.k: (r.filled, r.notional, r.vwap, r.depth_limited, r.fee, r.fee_conservative) for r in out.collect()}
    assert got == want


def test_boundary_and_partial_depth(spark):
    df = spark.createDataFrame([(1, 1, 0.40, 5.0), (1, 2, 0.50, 5.0), (1, 3, 0.6, 0.0)], LEVELS)
    full, part = (exact.walk(df, ["k"], "price", "size", n, ["n"]).first() for n in (10, 11))
    assert (full.vwap, full.depth_limited) == (Decimal("0.45"), False) and (part.filled, part.depth_limited) == (10, True)


def test_the_fee_curve_is_symmetric_and_rounds_up_once(spark):
    df = spark.createDataFrame([(i, 1, p, 1.0) for i, p in enumerate((0.02, 0.5, 0.98))], LEVELS)
    low, middle, high = (r.fee_conservative for r in exact.walk(df, ["k"], "price", "size", 1, ["n"], F.lit("0.07").cast("decimal(6,4)")).orderBy("k").collect())
    assert low == high == Decimal("0.0014") and middle == Decimal("0.0175")


def test_what_is_not_exact_is_an_error(spark):
    df = spark.createDataFrame([(1, 1, 0.12345, 1.0)], LEVELS)
    with pytest.raises(Exception, match="not exact in 4 places"):
        exact.walk(df, ["k"], "price", "size", 1, ["n"]).collect()
    with pytest.raises(ValueError, match="places"):
        exact.fee(F.lit(0), F.lit(0), F.lit(0), 5)


def test_baskets(spark):
    rows = [(1, "0.49", "0.001", False), (1, "0.49", "0.001", False), (2, "0.6", "0.01", False), (3, "0.6", None, False), (3, "0.5", "0.1", False), (4, "0.5", "0.1", True), (4, None, "0.1", False), (5, "0.7", "0.1", False), (5, "0.7", "0.1", False)]
    legs = spark.createDataFrame(rows, "b long, notional string, fee_conservative string, depth_limited boolean").withColumns({"notional": F.col("notional").cast("decimal(38,8)"), "fee_conservative": F.col("fee_conservative").cast("decimal(28,4)")})
    got = {r.b: (r.net, r.profit_per_contract, r.exclusion) for r in exact.measure(legs, ["b"], F.lit(2), 1).collect()}
    assert got[1] == (Decimal("0.982"), Decimal("0.018"), None) and got[5] == (Decimal("1.6"), Decimal("-0.6"), None)
    assert [got[i][2] for i in (2, 3, 4)] == ["one_sided", "fee_missing", "one_sided"]
