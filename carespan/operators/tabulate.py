"""Presentation tables: cross-tabulation, description and paired comparison."""

from __future__ import annotations

import math
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from carespan.functions.text import percent_text
from carespan.session import written

# Fixed value: multiplier of the standard error for the interval.
INTERVAL_FACTOR = 1.98


OTHER = "Other"


def crosstab_report(df: DataFrame, columns: str, rows: str, values: Sequence[str], count: str) -> DataFrame:
    """Counts of ``columns`` values per ``rows`` value with column percentages.

    ``values`` fixes the output columns; any further value counts under OTHER, and a row
    label stays whatever its values are. Grand totals are one scalar row, so
    nothing but the small counted table is read twice.
    """
    label = F.when(F.col(columns).isin(list(values)), F.col(columns)).when(F.col(columns).isNotNull(), F.lit(OTHER))
    values = [*values, OTHER]
    counted = (
        df.where(F.col(rows).isNotNull())
        .groupBy(rows)
        .agg(*[F.count(F.when(label == v, F.col(count))).alias(v) for v in values])
    )
    counted = counted.withColumn("Total", sum((F.col(v) for v in values[1:]), F.col(values[0])))
    names = [*values, "Total"]
    grand = counted.agg(F.struct(*[F.sum(n).alias(n) for n in names]).alias("g")).scalar()
    out = counted.withColumn("_g", grand)
    shares = {n: percent_text(F.col(n), F.col(f"_g.{n}")) for n in names}
    return out.select(
        rows,
        *names,
        *[shares[n].alias(f"{n}_Perc") for n in names],
        *[F.concat(F.col(n).cast("string"), F.lit(" ("), shares[n], F.lit(")")).alias(f"{n}_Text") for n in names],
        *[F.concat(F.lit(f"{v} (n="), F.col(f"_g.{v}").cast("string"), F.lit(") (%)")).alias(f"{v}_Heading") for v in values],
    )


def describe_report(df: DataFrame, group: str, value: str, kind: str) -> DataFrame:
    """Per group and in total: 'mean (std)' or 'median (p25, p75)' as text with two decimals, count, least and most.

    The rows are summed per group once; the total comes from the groups' sums. Percentiles are
    exact and interpolated.
    """
    own = df.where(F.col(value).isNotNull()).select(F.col(group).cast("string").alias("Group"), F.col(value).cast("double").alias("v"))
    if kind == "mean":
        groups = own.groupBy("Group").agg(
            F.count("v").alias("n"), F.avg("v").alias("a"), F.var_pop("v").alias("var"), F.min("v").alias("low"), F.max("v").alias("high")
        )
        mean = groups.agg((F.sum(F.col("n") * F.col("a")) / F.sum("n")).alias("m")).scalar()
        away = F.col("a") - mean
        total = groups.select("*", (F.col("n") * (F.col("var") + away * away)).alias("squares")).agg(
            F.lit("Total").alias("Group"),
            F.sum("n").alias("n"),
            (F.sum(F.col("n") * F.col("a")) / F.sum("n")).alias("a"),
            (F.sum("squares") / F.sum("n")).alias("var"),
            F.min("low").alias("low"),
            F.max("high").alias("high"),
        )
        stats = groups.where("Group IS NOT NULL").unionByName(total.where("n > 0"))
        s = F.when(F.col("n") > 1, F.sqrt(F.col("var") * F.col("n") / F.greatest(F.col("n") - 1, F.lit(1))))
        text = F.concat(_fixed(F.col("a")), F.lit(" ("), _fixed(s), F.lit(")"))
    else:
        stats = exact_quantiles(own, "Group", "v", [0.25, 0.5, 0.75], total="Total").withColumnRenamed("quantiles", "q")
        text = F.concat(
            _fixed(F.col("q")[1]), F.lit(" ("), _fixed(F.col("q")[0]), F.lit(", "), _fixed(F.col("q")[2]), F.lit(")")
        )
    description = F.lit(f"{value} {kind}").alias("Description")
    return stats.select("Group", description, text.alias("Final"), F.col("n").alias("Count"), F.col("low").alias("Min"), F.col("high").alias("Max"))


SKETCH_SIZE = 4000  # of a group's quantile sketch: some 100 kB, whatever it has seen
RANK_ERROR = 0.006  # of its ranks: over four times what it errs by at most with a chance of 99%, and a place or two among over FEW values
FEW = 1000  # values that are their own band


def _ranks(n: Column, probabilities: Sequence[float]) -> list[Column]:
    """Places from 0, with fractions, of the wanted quantiles among n sorted values."""
    return [F.lit(p) * (n - 1) for p in probabilities]


def exact_quantiles(rows: DataFrame, group: str, value: str, probabilities: Sequence[float], total: str | None = None) -> DataFrame:
    """Per group: exact interpolated quantiles as an array in the order of ``probabilities``, n, low and high.

    With ``total`` there is a group of that name over all rows, and rows without a group count only there.

    A first pass makes a mergeable sketch per group (that of all rows is merged from those) and takes
    from it, for each wanted rank, two values that hold the rank between them for certain or nearly so. A second pass counts how many values lie below
    the lower and how often each one between them occurs, so what is sorted is a band of about a hundredth of the
    values, each once. A rank that its band misses after all is looked for among all values of its group, in a third
    pass that otherwise isn't made. Bands and what they hold, a few rows a group, are written in between.
    """
    own = rows.select(F.col(group).alias(group), F.col(value).alias("v")).where("v IS NOT NULL")
    sketch = F.call_function("kll_sketch_agg_double", F.col("v").cast("double"), F.lit(SKETCH_SIZE)).alias("sketch")
    parts = own.groupBy(group).agg(sketch, F.count("v").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
    ranges = parts.where(F.col(group).isNotNull())
    if total is not None:
        merged = F.call_function("kll_merge_agg_double", F.col("sketch"), F.lit(SKETCH_SIZE)).alias("sketch")
        whole = parts.agg(merged, F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"))
        ranges = ranges.unionByName(whole.where("n > 0").select(F.lit(total).alias(group), "sketch", "n", "low", "high"))

    places = _ranks(F.col("n"), probabilities)
    clipped = lambda p: float(min(max(p, 0.0), 1.0))
    bounds = {
        side: F.call_function(
            "kll_sketch_get_quantile_double", F.col("sketch"), F.array(*[F.lit(clipped(p + sign * RANK_ERROR)) for p in probabilities])
        )
        for side, sign in (("from", -1), ("to", 1))
    }
    few = F.col("n") <= FEW
    asked = F.array(
        *[
            F.struct(
                f(place).cast("bigint").alias("rank"),
                F.when(few | F.lit(p <= RANK_ERROR), F.col("low")).otherwise(F.get("from", F.lit(k))).alias("from"),
                F.when(few | F.lit(p >= 1 - RANK_ERROR), F.col("high")).otherwise(F.get("to", F.lit(k))).alias("to"),
            )
            for k, (p, place) in enumerate(zip(probabilities, places))
            for f in (F.floor, F.ceil)
        ]
    )
    bands = (
        ranges.withColumns(bounds)
        .select(group, "n", "low", "high", F.inline(asked))
        .groupBy(group, "n", "low", "high", "rank")
        .agg(F.min("from").alias("from"), F.max("to").alias("to"))
    )
    bands = written(bands, "quantile-bands")
    held = bands.groupBy(group).agg(F.collect_list(F.struct("rank", "from", "to")).alias("bands"))

    names = F.array_compact(F.array(F.col(group), F.lit(total))) if total is not None else F.array_compact(F.array(F.col(group)))
    every = own.select(F.explode(names).alias(group), "v")
    within = (
        every.join(held, group)
        .select(group, "v", F.explode("bands").alias("band"))
        .where("v <= band.to")
        .groupBy(group, F.col("band.rank").alias("rank"), F.when(F.col("v") >= F.col("band.from"), F.col("v")).alias("at"))
        .agg(F.count(F.lit(1)).alias("times"))
    )
    found = written(_at_rank(within, group), "quantiles-found")
    missed = bands.select(group, "rank").join(found, [group, "rank"], "left_anti")
    if not missed.isEmpty():
        anew = every.join(missed, group).groupBy(group, "rank", F.col("v").alias("at")).agg(F.count(F.lit(1)).alias("times"))
        found = found.unionByName(_at_rank(anew, group))
    values = found.groupBy(group).agg(F.map_from_entries(F.collect_list(F.struct("rank", "at"))).alias("values"))

    def interpolated(place: Column) -> Column:
        below = F.element_at("values", F.floor(place).cast("bigint"))
        above = F.element_at("values", F.ceil(place).cast("bigint"))
        return below + (place - F.floor(place)) * (above - below)

    out = bands.select(group, "n", "low", "high").distinct().join(values, group)
    return out.select(group, "n", "low", "high", F.array(*[interpolated(p) for p in places]).alias("quantiles"))


def _at_rank(counted: DataFrame, group: str) -> DataFrame:
    """(group, rank, at): the value at its rank, from counts by value; those below the band have a NULL value and come first."""
    ordered = W.partitionBy(group, "rank").orderBy(F.col("at").asc_nulls_first())
    until = F.sum("times").over(ordered.rowsBetween(W.unboundedPreceding, W.currentRow))
    reached = counted.withColumn("until", until).where("until > rank AND until - times <= rank AND at IS NOT NULL")
    return reached.select(group, "rank", "at")


def _fixed(number: Column) -> Column:
    return F.coalesce(F.format_string("%.2f", number), F.lit("nan"))


def paired_summary(df: DataFrame, first: str, second: str) -> DataFrame:
    """n, mean, standard deviation and standard error of both columns, and the paired t statistic."""
    a, b = F.col(first).cast("double"), F.col(second).cast("double")
    pairs = df.where(a.isNotNull() & b.isNotNull()).select(a.alias("a"), b.alias("b"), (a - b).alias("d"))
    stats = pairs.agg(
        F.count(F.lit(1)).alias("n"),
        *[f(c).alias(f"{name}_{c}") for c in ("a", "b", "d") for name, f in (("mean", F.avg), ("std", F.stddev_samp))],
    )
    root = F.sqrt(F.col("n").cast("double"))
    difference = F.sqrt((F.col("std_a") * F.col("std_a") + F.col("std_b") * F.col("std_b")) / F.col("n"))
    return stats.select(
        "n",
        F.col("mean_a").alias("First_Mean"),
        F.col("std_a").alias("First_Std"),
        (F.col("std_a") / root).alias("First_Sem"),
        F.col("mean_b").alias("Second_Mean"),
        F.col("std_b").alias("Second_Std"),
        (F.col("std_b") / root).alias("Second_Sem"),
        (F.col("mean_d") / (F.col("std_d") / root)).alias("T_Statistic"),
        difference.alias("SE_diff"),
        (difference * INTERVAL_FACTOR).alias("CI_95"),
    )


INTERVALS = 4000  # of the density's integral
REACH = 40.0  # standard deviations beyond the statistic; what lies behind is below 1e-300


def _gamma_ratio(x: Column) -> Column:
    """Gamma(x + 1/2) / Gamma(x), from the asymptotic series at x + 20."""
    moved = x + 20.0
    series = 1 - 1 / (8 * moved) + 1 / (128 * moved**2) + 5 / (1024 * moved**3) - 21 / (32768 * moved**4) - 399 / (262144 * moved**5)
    down = F.aggregate(
        F.sequence(F.lit(0), F.lit(19)), F.lit(1.0), lambda acc, k: acc * (x + k) / (x + k + 0.5)
    )
    return F.sqrt(moved) * series * down


def two_sided_p(t: Column, degrees: Column) -> Column:
    """Two-sided Student t probability as a column expression.

    With x = sqrt(degrees) tan(u) the density's tail is the integral of cos(u) ** (degrees - 1) from
    atan(|t| / sqrt(degrees)) on; Simpson's rule over at most REACH / sqrt(degrees) is exact to
    about 1e-10 for any number of degrees.
    """
    freedom = degrees.cast("double")
    start = F.atan(F.abs(t) / F.sqrt(freedom))
    width = (F.least(F.lit(math.pi / 2), start + REACH / F.sqrt(freedom)) - start) / INTERVALS
    term = lambda k: F.when(k % INTERVALS == 0, 1.0).when(k % 2 == 1, 4.0).otherwise(2.0) * F.pow(
        F.cos(start + k * width), freedom - 1
    )
    area = F.aggregate(F.sequence(F.lit(0), F.lit(INTERVALS)), F.lit(0.0), lambda acc, k: acc + term(k)) * width / 3
    p = 2 * _gamma_ratio(freedom / 2) / math.sqrt(math.pi) * area
    return F.when((degrees >= 1) & t.isNotNull() & ~F.isnan(t), F.least(p, F.lit(1.0)))


def paired_stats(df: DataFrame, first: str, second: str) -> DataFrame:
    """The paired summary with its p-value, which is worked out on the single result row."""
    return paired_summary(df, first, second).withColumn("p_value", two_sided_p(F.col("T_Statistic"), F.col("n") - 1))
