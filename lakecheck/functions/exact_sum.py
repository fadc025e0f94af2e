"""Exact, order-independent sums of doubles with built-in expressions.

A finite double is a whole number of 2^-1074.  Written in base 2^24 it has at most four digits that are not zero; each
is cut out exactly (a division by a power of two, floors and remainders, none of which rounds).  A row gives one record:
the place of its first digit, and four digits from there on.  Records of one first place are summed as longs, with the
row's multiplicity, by an ordinary grouped sum: at most 88 first places, combined in each task before the shuffle; only
those few sums are then set at their places.  Carrying the places' sums gives the exact total; only the last step rounds it.
NaN and the infinities are counted at places of their own, so they neither vanish nor hide the rest.

A place holds sums below 2^63, so about 2^38 rows; beyond that the grouped sum raises an overflow, it never wraps.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS, LOWEST, PLACES = 24, -1074, 88
DIGITS = 4                             # 53 bits lie on at most four places, also where the first is one off
NAN, PLUS, MINUS = -1, -2, -3          # places of NaN and the infinities
BASE = 1 << BITS


def _unit(place: Column) -> Column:
    return F.pow(F.lit(2.0), place * BITS + LOWEST)


def first_place(x: Column) -> Column:
    """The place of a double's first base-2^24 digit, or the place of its mark; NULL for NULL and zero.  Where the logarithm
    rounds over a power of two, it is one too high (the digit there is 0) or one too low (the digit has a bit more)."""
    finite = F.floor((F.log2(F.abs(x)) - LOWEST) / BITS).cast("int")
    return (F.when(F.isnan(x), F.lit(NAN)).when(x == float("inf"), F.lit(PLUS)).when(x == float("-inf"), F.lit(MINUS))
            .when(x != 0, F.greatest(finite, F.lit(0))))


def places(df: DataFrame, values: Sequence[Column], weights: Sequence[Column]) -> DataFrame:
    """(series, place, w0, w1, ...): per value column (``series`` is its position) and place, the sums of digit times
    each weight.  At most 91 rows a series."""
    w = [f"w{i}" for i in range(len(weights))]
    named = df.select(*[v.cast("double").alias(f"v{i}") for i, v in enumerate(values)], *[x.cast("bigint").alias(n) for x, n in zip(weights, w)])
    series = F.explode(F.array(*[F.struct(F.lit(i).alias("series"), F.col(f"v{i}").alias("x")) for i in range(len(values))])).alias("s")
    each = named.select(series, *w).select(F.col("s.series").alias("series"), F.col("s.x").alias("x"), *w)
    each = each.select("series", "x", first_place(F.col("x")).alias("first"), *w).where(F.col("first").isNotNull())
    # a finite value in units of its first place; a mark counts as one there.  A scaling by 2^24 never rounds
    each = each.withColumn("r", F.when(F.col("first") < 0, F.lit(1.0)).otherwise(F.col("x") / _unit(F.col("first"))))
    for j in range(DIGITS):
        each = each.withColumn(f"d{j}", F.col("r").cast("bigint"))             # towards zero, so a digit has the value's sign
        if j + 1 < DIGITS:
            each = each.withColumn("r", (F.col("r") - F.col(f"d{j}").cast("double")) * F.lit(float(BASE)))
    firsts = each.groupBy("series", "first").agg(*[F.sum(F.col(f"d{j}") * F.col(x)).alias(f"{x}_{j}") for x in w for j in range(DIGITS)])
    at = F.explode(F.array(*[F.struct((F.col("first") - j).alias("place"), *[F.col(f"{x}_{j}").alias(x) for x in w]) for j in range(DIGITS)])).alias("d")
    return (firsts.select("series", "first", at).where((F.col("d.place") >= 0) | (F.col("d.place") == F.col("first")))
            .groupBy("series", F.col("d.place").alias("place")).agg(*[F.sum(f"d.{x}").alias(x) for x in w]))


def _carried(sums: Column) -> Column:
    """(carry, value): places' sums carried into digits from 0 to 2^24 - 1, lowest first, and the digits' value as a double.
    The part below a digit is less than its unit, so adding upwards rounds by less than a unit in the last place in all."""
    start = F.struct(F.lit(0).cast("bigint").alias("carry"), F.lit(0).alias("place"), F.lit(0.0).alias("value"))

    def step(state: Column, v: Column) -> Column:
        whole = v + state["carry"]
        low = F.pmod(whole, F.lit(BASE).cast("bigint"))
        more = F.when(low == 0, F.lit(0.0)).otherwise(low.cast("double") * _unit(state["place"]))
        return F.struct(F.shiftright(whole, BITS).alias("carry"), (state["place"] + 1).alias("place"), (state["value"] + more).alias("value"))
    return F.aggregate(sums, start, step)


def total(by_place: Column) -> dict[str, Column]:
    """From a map place -> sum: ``value`` (the total as a double), ``finite`` (that of the finite part) and ``marks`` (counts of
    NaN, +inf and -inf)."""
    get = lambda p: F.coalesce(F.try_element_at(by_place, p), F.lit(0).cast("bigint"))
    sums = F.transform(F.sequence(F.lit(0), F.lit(PLACES + 1)), get)
    plus, minus = _carried(sums), _carried(F.transform(sums, lambda v: -v))
    finite = F.when(plus["carry"] < 0, -minus["value"]).otherwise(plus["value"])
    nan, up, down = (get(F.lit(p)) for p in (NAN, PLUS, MINUS))
    value = (F.when((nan != 0) | ((up != 0) & (down != 0)), F.lit(float("nan"))).when(up != 0, F.lit(float("inf")))
             .when(down != 0, F.lit(float("-inf"))).otherwise(finite))
    return {"value": value, "finite": finite, "marks": F.array(nan, up, down)}


def exact_sums(df: DataFrame, values: Sequence[Column], left: Column | None = None, right: Column | None = None) -> DataFrame:
    """(series, left, right, difference, marks_equal): exact totals of each value column weighted by ``left`` and by
    ``right`` (each 1 if not given), the exact total of the differences of the weights, rounded once, and
    whether both sides have as many NaN and infinities.  One row a series, also without rows."""
    one = F.lit(1)
    p = places(df, values, [one if left is None else left, one if right is None else right])
    p = p.withColumn("w2", F.col("w0") - F.col("w1"))
    maps = p.groupBy("series").agg(*[F.map_from_entries(F.collect_list(F.struct("place", f"w{i}"))).alias(f"m{i}") for i in range(3)])  # <= 91 entries
    every = df.sparkSession.range(len(values)).select(F.col("id").cast("int").alias("series"))
    empty = F.create_map().cast("map<int,bigint>")
    have = every.join(F.broadcast(maps), "series", "left").withColumns({f"m{i}": F.coalesce(f"m{i}", empty) for i in range(3)})  # one row a series
    a, b, d = (total(F.col(f"m{i}")) for i in range(3))
    return have.select("series", a["value"].alias("left"), b["value"].alias("right"), d["finite"].alias("difference"),
                       F.array_compact(F.array(*[F.when(d["marks"][i] != 0, F.lit(1)) for i in range(3)])).alias("__marks")).withColumn(
        "marks_equal", F.size("__marks") == 0).drop("__marks")
