"""Sorting, top rows and samples."""

from pyspark.sql import Window
from pyspark.sql import functions as F


def stable_order(df, *by):
    """Total order by the given columns, ties in input order.

    The input position also cuts ties apart for the range partitioning, so
    that one value held by a third of the rows still spreads over many tasks.
    Positions must come out the same when a lost task is run again. They do for
    a scan and row-wise steps over it; send the result of a shuffle through
    ``checkpoint()`` first.
    """
    return (
        df.withColumn("_position", F.monotonically_increasing_id())
        .orderBy(*by, "_position").drop("_position")
    )


def most_frequent(counts, n=20, count="count"):
    """The n largest counts; the other columns break ties."""
    rest = [c for c in counts.columns if c != count]
    return counts.orderBy(F.desc(count), *rest).limit(n)


def random_rows(df, n, key, seed=""):
    """A sample of exactly n rows (all, if there are fewer).

    Rows are ordered by a digest of ``key``, which must tell rows apart, so
    the sample can be repeated. A first pass counts rows per digest prefix
    (2 ** 20 of them) and finds the prefix where n is reached; only rows up to
    it, little more than n, take part in the sort.
    """
    digest = F.md5(F.concat(F.lit(seed), F.col(key).cast("string")).cast("binary"))
    marked = df.withColumn("_digest", digest).withColumn("_prefix", F.substring("_digest", 1, 5))
    per_prefix = marked.groupBy("_prefix").count()
    running = F.sum("count").over(Window.orderBy("_prefix"))
    last_prefix = (
        per_prefix.withColumn("_before", running - F.col("count"))
        .filter(F.col("_before") < n).agg(F.max("_prefix"))
    )
    return (
        marked.filter(F.col("_prefix") <= last_prefix.scalar())
        .orderBy("_digest").limit(n).drop("_digest", "_prefix")
    )
