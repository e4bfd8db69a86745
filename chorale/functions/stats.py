"""Order statistics with explicit definitions: nearest rank with half-even rounding, and the upper median."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def pick_rank(values: Column, percent: float) -> Column:
    """Nearest rank of a sorted array: index round-half-even(percent / 100 * (n - 1)); empty: 0."""
    index = F.rint(F.lit(percent / 100.0) * (F.size(values) - 1)).cast("int")
    at = F.least(F.greatest(index, F.lit(0)), F.size(values) - 1)
    return F.when(F.size(values) > 0, F.get(values, at).cast("double")).otherwise(F.lit(0.0))


def nearest_rank(value: Column, percent: float) -> Column:
    """An aggregate for groups that fit in a task, such as one participant of one recording."""
    return pick_rank(F.sort_array(F.collect_list(value)), percent)


def upper_median(value: Column, fallback: float = 0.0) -> Column:
    """The element at index n div 2 of the sorted values; none: the fallback."""
    values = F.sort_array(F.collect_list(value))
    return F.when(F.size(values) > 0, F.get(values, F.floor(F.size(values) / 2).cast("int")).cast("double")).otherwise(F.lit(fallback))


#: Rank error of the approximate quantiles (a ten-thousandth of a group), and how far around them the exact value is looked for.
_ACCURACY, _MARGIN = 10_000, 5e-4
#: Rows of a group up to which all of it is: below, the margin may be less than a rank's rounding.
_SMALL = 8_000


def ranked_percentiles(df: DataFrame, keys: list[str], value: str, percents: dict[str, float]) -> DataFrame:
    """Nearest ranks for groups of any size: (keys, a column for each name of ``percents``), all in two passes.

    Approximate quantiles a margin below and above each rank, whose error is proven to be less than the margin, bracket
    the exact value.  The second pass counts what lies below each bracket and sorts only the thousandth inside.
    """
    given = df.where(F.col(value).isNotNull()).select(*keys, F.col(value).alias("__x"))
    shares = [s for p in percents.values() for s in (max(p / 100 - _MARGIN, 0.0), min(p / 100 + _MARGIN, 1.0))]
    brackets = given.groupBy(*keys).agg(F.percentile_approx("__x", shares, _ACCURACY).alias("__q"), F.count(F.lit(1)).alias("__n"))
    low, high = (lambda i: F.get("__q", F.lit(2 * i))), (lambda i: F.get("__q", F.lit(2 * i + 1)))
    # Where the margin reaches beyond the ends, so does the bracket.
    large = F.col("__n") > _SMALL
    first = lambda i, p: F.lit(False) if p / 100 - _MARGIN <= 0 else large & (F.col("__x") < low(i))
    last = lambda i, p: F.lit(False) if p / 100 + _MARGIN >= 1 else large & (F.col("__x") > high(i))
    place = F.array(*[F.when(first(i, p), F.lit(-1)).when(last(i, p), F.lit(1)).otherwise(F.lit(0)) for i, p in enumerate(percents.values())])
    # One row of a group for each percent and value inside, and one for each percent with all below.
    each = given.join(brackets, keys).select(*keys, "__n", "__x", F.posexplode(place).alias("__i", "__side")).where("__side <= 0")
    counts = each.groupBy(*keys, "__i", "__n", F.when(F.col("__side") == 0, F.col("__x")).alias("__x")).agg(F.count(F.lit(1)).alias("__c"))
    running = Window.partitionBy(*keys, "__i").orderBy(F.asc_nulls_first("__x")).rowsBetween(Window.unboundedPreceding, 0)
    upto = counts.withColumn("__upto", F.sum("__c").over(running))
    wanted = F.array(*[F.rint(F.lit(p / 100.0) * (F.col("__n") - 1)) for p in percents.values()])
    found = upto.withColumn("__rank", F.get(wanted, F.col("__i"))).where("__x is not null and __upto > __rank and __upto - __c <= __rank")
    return found.groupBy(*keys).agg(*[F.max(F.when(F.col("__i") == i, F.col("__x").cast("double"))).alias(name) for i, name in enumerate(percents)])
