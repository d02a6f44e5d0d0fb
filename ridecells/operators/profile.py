"""Column profiles."""

from functools import reduce
from math import ceil, floor

from pyspark.sql import Window
from pyspark.sql import functions as F

QUARTILES = (0.25, 0.5, 0.75)
#: Size of a quantile sketch, some hundred kilobytes, and rows that are ranked at ease.
SKETCH = 8192
MOST_RANKED = 1_000_000


def nulls_per_column(df):
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])


def _wide(df, columns):
    return df.select(*[F.col(c).cast("double").alias(f"v{i}") for i, c in enumerate(columns)])


def _facts(values, n_columns, shares, size):
    """Moments, extremes and brackets of the quantiles of all columns, in one pass: a row.

    The brackets come from one KLL sketch of each column.
    """
    measured, wanted = [], []
    for i in range(n_columns):
        v = f"v{i}"
        measured += [F.count(v).alias(f"n{i}"), F.avg(v).alias(f"mean{i}"), F.stddev_samp(v).alias(f"std{i}"), F.min(v).alias(f"min{i}"),
                     F.max(v).alias(f"max{i}"), F.kll_sketch_agg_double(v, F.lit(size)).alias(f"sketch{i}")]
        wanted += [F.col(f"{fact}{i}") for fact in ("n", "mean", "std", "min", "max")]
        wanted += [_bracket(f"sketch{i}", q, size).alias(f"ends{i}_{k}") for k, q in enumerate(shares)]
    return values.agg(*measured).select(*wanted).first()


def _slack(size):
    """Three times the error that a rank of such a sketch seldom exceeds."""
    return 3 * 2.3 / size ** 0.9


def _bracket(sketch, share, size):
    """Values on both sides of a quantile: exact at the ends, null for a sketch without values."""
    ends = [F.kll_sketch_get_quantile_double(sketch, F.lit(max(0.0, min(1.0, share + side * _slack(size))))) for side in (-1, 1)]
    held = F.kll_sketch_get_n_double(sketch) > 0
    return F.when(held, F.array(*ends))


def _brackets(values, facts, n_columns, shares, size, most):
    """(column, share, n, low, high, below): where each quantile lies, and the values below.

    Each bracket is counted, so it is known to hold its quantile; one that a
    sketch misplaced, which is rare, is opened on that side and taken as it is.
    While another holds more than ``most`` rows, its own values are sketched
    again, unless that no longer halves it, since then few values are repeated
    so often. So what is ranked doesn't grow with the table.
    """
    found, waiting = [], []
    for i in range(n_columns):
        lowest, highest = facts[f"min{i}"], facts[f"max{i}"]
        for k, q in enumerate(shares if facts[f"n{i}"] else []):
            low, high = facts[f"ends{i}_{k}"] or (lowest, highest)
            waiting.append((i, q, facts[f"n{i}"], low, high, None))
    while waiting:
        inside = [F.col(f"v{i}").between(low, high) for i, _, _, low, high, _ in waiting]
        counted = values.agg(*[c for k, (i, _, _, low, _, _) in enumerate(waiting) for c in (
            F.count_if(F.col(f"v{i}") < low).alias(f"below{k}"), F.count_if(inside[k]).alias(f"inside{k}"))]).first()
        wide, again = [], []
        for k, (i, q, n, low, high, before) in enumerate(waiting):
            below, held, position = counted[f"below{k}"], counted[f"inside{k}"], q * (n - 1)
            early, late = floor(position) < below, ceil(position) >= below + held
            if early or late:
                again.append((i, q, n, facts[f"min{i}"] if early else low, facts[f"max{i}"] if late else high, 0))
            elif held <= most or low == high or (before is not None and 2 * held > before):
                found.append((i, q, n, low, high, below))
            else:
                wide.append((k, held, (position - below) / max(1, held - 1)))
        sketches = [F.kll_sketch_agg_double(F.when(inside[k], F.col(f"v{waiting[k][0]}")), F.lit(size)).alias(f"s{k}") for k, _, _ in wide]
        ends = values.agg(*sketches).select(*[_bracket(f"s{k}", place, size).alias(f"s{k}") for k, _, place in wide]).first() if wide else {}
        for k, held, _ in wide:
            i, q, n, low, high, _ = waiting[k]
            again.append((i, q, n, *(ends[f"s{k}"] or (low, high)), held))
        waiting = again
    return found


def _ranked(values, brackets):
    """Value of each bracket's quantile, by its number: the different values inside are ranked, knowing how many lie below."""
    def of(k, place):
        return F.get(F.array(*[F.lit(b[place]) for b in brackets]), k)

    held = [F.when(F.col(f"v{i}").between(low, high), F.struct(F.lit(k).alias("k"), F.col(f"v{i}").alias("v")))
            for k, (i, _, _, low, high, _) in enumerate(brackets)]
    some = reduce(lambda a, b: a | b, [F.col(f"v{i}").between(low, high) for i, _, _, low, high, _ in brackets])
    kept = values.filter(some).select(F.explode(F.array(*held)).alias("x")).filter(F.col("x").isNotNull())
    counted = kept.groupBy("x.k", "x.v").agg(F.count("*").alias("rows"))
    upto = of(F.col("k"), 5) + F.sum("rows").over(Window.partitionBy("k").orderBy("v"))
    position = of(F.col("k"), 1) * (of(F.col("k"), 2) - 1)
    ranked = counted.select("k", "v", upto.alias("upto"), (upto - F.col("rows")).alias("first"), position.alias("position"))

    def order_statistic(rank):
        return F.max(F.when((F.col("first") <= rank) & (F.col("upto") > rank), F.col("v")))

    found = ranked.groupBy("k").agg(
        order_statistic(F.floor("position")).alias("low"), order_statistic(F.ceil("position")).alias("high"),
        F.max(F.col("position") - F.floor("position")).alias("part"))
    value = F.col("low") + (F.col("high") - F.col("low")) * F.col("part")
    return {r["k"]: r["value"] for r in found.select("k", value.alias("value")).collect()}  # a row per quantile


def _measured(df, columns, shares, size, most):
    """The facts, and the quantiles by (number of the column, share)."""
    values, shares = _wide(df, columns), sorted(shares)
    facts = _facts(values, len(columns), shares, size)
    brackets = _brackets(values, facts, len(columns), shares, size, most)
    quantiles = {(i, q): low for i, q, _, low, high, _ in brackets if low == high}
    open_ones = [b for b in brackets if b[3] != b[4]]
    if open_ones:
        quantiles |= {open_ones[k][:2]: value for k, value in _ranked(values, open_ones).items()}
    return facts, quantiles


def exact_quantiles(df, columns, shares=QUARTILES, size=SKETCH, most=MOST_RANKED):
    """Quantiles with linear interpolation: ``column, share, value``.

    A quantile lies between two order statistics. A pass over all columns
    brackets each of them with mergeable sketches of ``size``; a second counts
    the values below and inside the brackets and so checks them (further ones
    narrow brackets of more than ``most`` rows); the last ranks the different
    values inside, never the column as a whole. Not-a-numbers are the greatest
    values. A column without values has no quantile. The passes run when this
    is called; the driver gets a row of numbers from each, a few per quantile.
    """
    _, quantiles = _measured(df, columns, shares, size, most)
    rows = [(columns[i], q, value) for (i, q), value in sorted(quantiles.items())]
    return df.sparkSession.createDataFrame(rows, "column string, share double, value double")


def describe(df, columns, size=SKETCH, most=MOST_RANKED):
    """Count, mean, standard deviation, extremes and exact quartiles per column."""
    facts, quantiles = _measured(df, columns, QUARTILES, size, most)
    rows = [(c, *(facts[f"{k}{i}"] for k in ("n", "mean", "std", "min")), *(quantiles.get((i, q)) for q in QUARTILES), facts[f"max{i}"])
            for i, c in enumerate(columns)]
    numbers = ", ".join(f"{c} double" for c in ("mean", "std", "min", "q25", "q50", "q75", "max"))
    return df.sparkSession.createDataFrame(rows, f"column string, count bigint, {numbers}")


def histogram(df, column, bins=10):
    """Rows per equal-width bin between the extremes, the last bin closed.

    Empty bins are left out.
    """
    values = df.select(F.col(column).cast("double").alias("v")).filter(F.col("v").isNotNull())
    ends = values.agg(F.struct(F.min("v").alias("low"), F.max("v").alias("high")))
    placed = values.select("v", ends.scalar().alias("ends")).select("v", "ends.*")
    width = (F.col("high") - F.col("low")) / bins
    number = F.when(F.col("high") == F.col("low"), F.lit(0)).otherwise(
        F.least(F.floor((F.col("v") - F.col("low")) / width), F.lit(bins - 1))).cast("int")
    return (
        placed.withColumn("bin", number).groupBy("bin", "low", "high")
        .agg(F.count("*").alias("rows"))
        .select("bin", (F.col("low") + F.col("bin") * width).alias("bin_start"),
                (F.col("low") + (F.col("bin") + 1) * width).alias("bin_end"), "rows")
    )
