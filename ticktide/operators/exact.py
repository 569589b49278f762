"""Depth, fees and baskets in exact decimals: nothing is rounded but where a name says so.

Prices, sizes and rates have ``DIGITS`` decimal places; a value with more is an error, not a
rounding. Sums and products keep all their places, powers are products for whole exponents.
Two rules round, each once at the end: a quotient half up to ``QUOTIENT`` places, a fee up to
the next increment.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Decimal places of inputs and of quotients; the precision that Spark and others have.
DIGITS, QUOTIENT, PRECISION = 4, 12, 38


def decimal(x: Column, digits: int = DIGITS, whole: int = 14) -> Column:
    """``x`` with that many decimal places; an error if it has more or is too large. Null stays null."""
    out = x.try_cast(f"decimal({whole + digits},{digits})")
    same = out.cast("double") == x.cast("double")
    return F.when(x.isNull(), None).when(F.coalesce(same, F.lit(False)), out).otherwise(F.raise_error(F.concat(F.lit(f"not exact in {digits} places: "), x.cast("string"))).cast(f"decimal({whole + digits},{digits})"))


def quotient(a: Column, a_digits: int, b: Column, b_digits: int, digits: int = QUOTIENT) -> Column:
    """a / b half up to ``digits`` places, by whole numbers; null where b is zero. Both not negative."""
    shift = digits - a_digits + b_digits
    if shift < 0:
        raise ValueError("a quotient can't have fewer places than its dividend")
    up = F.lit(10**shift).cast(f"decimal({shift + 1},0)")
    num = ((a * 10**a_digits).cast("decimal(38,0)") * up).cast("decimal(38,0)")
    den = (b * 10**b_digits).cast("decimal(38,0)")
    twice, two = (2 * num + den).cast("decimal(38,0)"), (2 * den).cast("decimal(38,0)")
    whole = ((twice - twice % two).cast("decimal(38,0)") / two).cast("decimal(38,0)")  # a multiple of the divisor
    # wide types would cut places of the product: the quotient has as many digits as leave room
    unit = F.lit(f"0.{'0' * (digits - 1)}1").cast(f"decimal({digits},{digits})")
    return F.when(den != 0, (whole.cast(f"decimal({PRECISION - 2 - digits},0)") * unit).cast(f"decimal({PRECISION - 1},{digits})"))


def fills(levels: DataFrame, keys: list[str], price: str, size: str, contracts: int | str, order: list[str]) -> DataFrame:
    """Level rows with ``take``, as in ``ladder.fills``, price and size made exact."""
    levels = levels.withColumns({price: decimal(F.col(price)), size: decimal(F.col(size))}).where(F.col(size) > 0)
    w = Window.partitionBy(*keys).orderBy(price, *order).rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum(size).over(w), F.lit(0).cast("decimal(28,4)"))
    wanted = F.lit(str(contracts)).cast(f"decimal(18,{DIGITS})")
    return levels.withColumn("take", F.greatest(F.lit(0).cast("decimal(18,4)"), F.least(F.col(size), wanted - before)).cast(f"decimal(18,{DIGITS})"))


def power(x: Column, digits: int, exponent: int) -> tuple[Column, int]:
    """(x to a whole power, its places) for x from 0 to 1, by exact products."""
    if exponent < 0 or int(exponent) != exponent or digits * exponent > PRECISION:
        raise ValueError(f"no exact power {exponent} of {digits} places")
    out, places = F.lit(1).cast("decimal(1,0)"), 0
    for _ in range(int(exponent)):
        places += digits
        out = (out * x).cast(f"decimal({places + 1 if places < PRECISION else PRECISION},{places})")
    return out, places


def fee(price: Column, quantity: Column, rate: Column, exponent: int = 1) -> tuple[Column, int]:
    """(rate * quantity * (p (1 - p)) ^ exponent, its places), all of them kept; p (1 - p) below zero counts as zero."""
    odds = F.greatest(F.lit(0).cast("decimal(9,8)"), (price * (1 - price)).cast(f"decimal({2 * DIGITS + 1},{2 * DIGITS})"))
    raised, places = power(odds, 2 * DIGITS, exponent)
    places += 2 * DIGITS
    if places > PRECISION - 6:
        raise ValueError(f"a fee with exponent {exponent} has {places} places; no room is left for whole numbers")
    scaled = (rate.cast(f"decimal({DIGITS + 2},{DIGITS})") * quantity).cast(f"decimal({2 * DIGITS + 14},{2 * DIGITS})")
    if exponent == 0:
        return scaled, places
    # the product of both types would be over the precision: what is below 10^6 fits
    return (scaled.cast(f"decimal({2 * DIGITS + 6},{2 * DIGITS})") * raised.cast(f"decimal({places - 2 * DIGITS},{places - 2 * DIGITS})")).cast(f"decimal({PRECISION},{places})"), places


def round_up(x: Column, places: int, digits: int = DIGITS) -> Column:
    """Up to the next increment of ``digits`` places; whole increments stay."""
    unit = F.lit(f"{10.0**-digits:.{digits}f}").cast(f"decimal({digits + 1},{digits})")
    rest = x % unit
    return (x - rest + F.when(rest > 0, unit).otherwise(F.lit(0).cast(f"decimal({digits + 1},{digits})"))).cast(f"decimal(28,{digits})")


def walk(levels: DataFrame, keys: list[str], price: str, size: str, contracts: int | str, order: list[str], rate: Column | None = None, exponent: int = 1) -> DataFrame:
    """Per key: filled, notional (both exact), vwap (``QUOTIENT`` places), depth_limited; with ``rate`` also fee (exact) and fee_conservative."""
    taken = fills(levels, keys, price, size, contracts, order).withColumn("_notional", (F.col("take") * F.col(price)).cast(f"decimal(28,{2 * DIGITS})"))
    sums = [F.sum("take").cast("decimal(28,4)").alias("filled"), F.sum("_notional").cast(f"decimal(38,{2 * DIGITS})").alias("notional")]
    places = 0
    if rate is not None:
        one, places = fee(F.col(price), F.col("take"), rate, exponent)
        sums.append(F.sum(one).cast(f"decimal({PRECISION},{places})").alias("fee"))
    out = taken.groupBy(*keys).agg(*sums)
    out = out.withColumn("vwap", quotient(F.col("notional"), 2 * DIGITS, F.col("filled"), DIGITS)).withColumn("depth_limited", F.col("filled") < F.lit(str(contracts)).cast("decimal(18,4)"))
    return out if rate is None else out.withColumn("fee_conservative", round_up(F.col("fee"), places))


def measure(legs: DataFrame, keys: list[str], wanted: Column, contracts: int, payoff: int = 1) -> DataFrame:
    """Baskets of walked legs, each of ``contracts``: totals gross, net and profit, exact, and profit per contract.

    ``legs``: notional, fee_conservative, depth_limited. A basket counts if all its legs are there, filled
    and have a fee; else its numbers are null and ``exclusion`` says why. What it pays is ``payoff`` a contract.
    """
    out = legs.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("legs"), F.max(wanted).alias("_wanted"), F.sum("notional").cast(f"decimal(28,{2 * DIGITS})").alias("gross"), F.sum("fee_conservative").cast(f"decimal(24,{DIGITS})").alias("_fee"),
        F.bool_or(F.col("notional").isNull()).alias("_bare"), F.bool_or("depth_limited").alias("_short"), F.bool_or(F.col("fee_conservative").isNull()).alias("_free"),
    )
    reason = F.when(F.col("_bare") | (F.col("legs") < F.col("_wanted")), "one_sided").when(F.col("_short"), "depth_limited").when(F.col("_free"), "fee_missing")
    net = (F.col("gross") + F.col("_fee")).cast(f"decimal(28,{2 * DIGITS})")
    out = out.withColumn("exclusion", reason).withColumn("net", F.when(F.col("exclusion").isNull(), net))
    out = out.withColumn("profit", (F.lit(payoff * contracts).cast("decimal(18,0)") - F.col("net")).cast(f"decimal(28,{2 * DIGITS})"))
    each = quotient(F.abs("profit"), 2 * DIGITS, F.lit(str(contracts)).cast("decimal(18,4)"), DIGITS)
    return out.withColumn("profit_per_contract", F.when(F.col("profit") < 0, -each).otherwise(each)).drop("_wanted", "_fee", "_bare", "_short", "_free")
