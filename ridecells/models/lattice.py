"""Predictions kept per class of conditions and class of cells.

Trees compare a feature with a few numbers, its cuts. Values between the same
two cuts form a class, and all values of a class have the same prediction; a
value that equals a cut is a class of its own, so it doesn't matter how the
trees compare. One member of each class is scored. A forest of 32 bins has at
most 32 x 32 classes of cells, however many cells and reports there are.
"""

from bisect import bisect_left
from itertools import product

from pyspark.sql import functions as F

from ridecells.functions.numbers import round_half_up
from ridecells.operators.joins import with_all_cells
from ridecells.schemas import GRID_COLUMNS, GRID_ROWS, RAIN_EDGES, TEMPERATURE_EDGES
from ridecells.session import stored

#: Every value that the conditions of a report can have.
CONDITION_VALUES = {
    "weekday": range(1, 8), "hour": range(24), "temperature": range(len(TEMPERATURE_EDGES) + 1),
    "precipitation": range(len(RAIN_EDGES) + 1),
}
CONDITIONS = list(CONDITION_VALUES)
#: Counts of a table that may be broadcast, 64 MB of them.
_BROADCAST_COUNTS = 8_000_000


def _class(cuts, value):
    at = bisect_left(cuts, value)
    return at, at < len(cuts) and cuts[at] == value


def _classes(cuts, values):
    """The first member of each class, and for each value the number of its class."""
    first, numbers = {}, []
    for value in values:
        kind = _class(cuts, value)
        first.setdefault(kind, value)
        numbers.append(list(first).index(kind))
    return list(first.values()), numbers


class Lattice:
    """The classes that a model's cuts make of the conditions and of the grid."""

    def __init__(self, cuts):
        self.xs, self.x_class = _classes(cuts.get("cell_index_x", []), range(GRID_COLUMNS))
        self.ys, self.y_class = _classes(cuts.get("cell_index_y", []), range(GRID_ROWS))
        own = {c: _classes(cuts.get(c, []), values) for c, values in CONDITION_VALUES.items()}
        self.conditions = []  # (values, first members of their classes)
        for values in product(*CONDITION_VALUES.values()):
            at = (own[c][1][CONDITION_VALUES[c].index(v)] for c, v in zip(CONDITIONS, values))
            self.conditions.append((*values, *(own[c][0][k] for c, k in zip(CONDITIONS, at))))

    def place(self, x, y):
        """Place of a cell's class in the lists of counts."""
        xs, ys = (F.array(*map(F.lit, numbers)) for numbers in (self.x_class, self.y_class))
        return F.get(xs, F.col(x)) * len(self.ys) + F.get(ys, F.col(y))

    def counts(self, spark, scorer):
        """One stored row for every combination of conditions, with ``counts``: the rounded predictions by class of cells."""
        firsts = [f"first_{c}" for c in CONDITIONS]
        layout = ", ".join(f"{c} int" for c in CONDITIONS + firsts)
        known = spark.createDataFrame(self.conditions, layout)  # the domain of the conditions: 2,520 rows
        cells = spark.createDataFrame([(y * GRID_COLUMNS + x,) for x in self.xs for y in self.ys], "cell_id int")
        asked = known.select(*[F.col(f).alias(c) for f, c in zip(firsts, CONDITIONS)]).distinct()
        scored = scorer(with_all_cells(asked, cells)).withColumn("place", self.place("cell_index_x", "cell_index_y"))
        lists = scored.groupBy(*CONDITIONS).agg(
            F.sort_array(F.collect_list(F.struct("place", round_half_up("prediction").alias("count")))).alias("found"))
        whole = F.size("found") == len(self.xs) * len(self.ys)
        counts = F.when(whole, F.col("found.count")).otherwise(F.raise_error(F.lit("the scorer left cells out")).cast("array<bigint>"))
        lists = lists.select(*[F.col(c).alias(f) for f, c in zip(firsts, CONDITIONS)], counts.alias("counts"))
        table = stored(known.join(lists, firsts).select(*CONDITIONS, "counts"), "lattice")
        small = len(self.conditions) * len(self.xs) * len(self.ys) <= _BROADCAST_COUNTS
        return F.broadcast(table) if small else table

    def predict(self, reports, counts, cells=None):
        """Reports with their conditions to ``datetime, cell_id, count`` of every cell."""
        crossed = with_all_cells(reports, cells, beside=lambda rows: rows.join(counts, CONDITIONS))
        return crossed.select("datetime", "cell_id", F.get("counts", self.place("cell_index_x", "cell_index_y")).alias("count"))
