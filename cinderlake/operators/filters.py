"""Null-aware row filters, a chain of them, and display predicates."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cinderlake import schema
from cinderlake.functions.parsing import is_false_alarm, num


@dataclass(frozen=True)
class RowFilter:
    """A named filter. `drops` gives the condition of removed rows, or None when it does not
    apply to the columns at hand; `frame` is used instead for an arbitrary frame function."""

    name: str
    description: str
    drops: Callable[[list[str]], Column | None] | None = None
    frame: Callable[[DataFrame], DataFrame] | None = None

    def dropped(self, df: DataFrame) -> Column:
        condition = self.drops(df.columns) if self.drops else None
        return F.lit(False) if condition is None else F.coalesce(condition, F.lit(False))

    def apply(self, df: DataFrame) -> DataFrame:
        return df.transform(self.frame) if self.frame else df.filter(~self.dropped(df))


def drop_false_alarms(column: str = "FALSOALARME") -> RowFilter:
    return RowFilter(
        "false_alarm", "drops records marked as false alarms",
        lambda cols: is_false_alarm(column) if column in cols else None)


def drop_missing_coordinates(lat: str = "LAT", lon: str = "LON") -> RowFilter:
    """Drops rows with an unreadable coordinate or with both coordinates zero."""
    def drops(cols):
        if lat not in cols or lon not in cols:
            return None
        y, x = num(lat), num(lon)
        return y.isNull() | x.isNull() | ((y == 0) & (x == 0))
    return RowFilter("missing_coordinates", "drops records without usable coordinates", drops)


def drop_small_areas(min_area: float = 0.1, column: str = "AREATOTAL") -> RowFilter:
    """Drops areas below `min_area`; a missing or unreadable area is kept."""
    return RowFilter(
        "small_area", f"drops records with an area below {min_area}",
        lambda cols: num(column) < min_area if column in cols else None)


def drop_value(value: str, column: str = "TIPO") -> RowFilter:
    """Drops one exact value; missing values are kept."""
    return RowFilter(
        f"{column.lower()}_{value.lower()}", f"drops records whose {column} is {value}",
        lambda cols: F.col(column).eqNullSafe(value))


def custom(name: str, description: str, frame: Callable[[DataFrame], DataFrame]) -> RowFilter:
    """Any function from frame to frame."""
    return RowFilter(name, description, frame=frame)


@dataclass
class FilterChain:
    """Filters applied in order; consecutive conditions end up in one scan filter."""

    filters: list[RowFilter] = field(default_factory=list)

    def add(self, row_filter: RowFilter) -> FilterChain:
        self.filters.append(row_filter)
        return self

    def apply(self, df: DataFrame) -> DataFrame:
        for row_filter in self.filters:
            df = row_filter.apply(df)
        return df

    def report(self, df: DataFrame) -> DataFrame:
        """`step, filter, removed, original, removed_share` per filter, plus a `total` row.

        Each row is tagged with the first filter that drops it, and all counts of a run of
        conditions come from one pass. A frame function ends a run, since only running it shows
        what it drops; the run after it is one more pass.
        """
        runs: list[tuple[DataFrame, int, list[RowFilter]]] = [(df, 0, [])]
        for i, f in enumerate(self.filters):
            if f.frame is None:
                runs[-1][2].append(f)
            else:
                runs.append((f.apply(FilterChain(runs[-1][2]).apply(runs[-1][0])), i + 1, []))

        counted = [_run_counts(frame, first, run) for frame, first, run in runs]
        counts = reduce(DataFrame.unionByName, counted).agg(
            F.map_from_entries(F.collect_list(F.struct("key", "n"))).alias("m"))  # two numbers per filter

        def at(key: str) -> Column:
            return F.col("m")[key]

        removed: dict[int, Column] = {}
        left = None
        for r, (_, first, run) in enumerate(runs):
            if r:
                removed[first - 1] = left - at(f"in{first}")
            left = at(f"in{first}")
            for i in range(first, first + len(run)):
                removed[i] = at(f"out{i}")
                left = left - at(f"out{i}")
        original = at("in0")
        rows = [F.struct(F.lit(i + 1).alias("step"), F.lit(f.name).alias("filter"), removed[i].alias("removed"),
                         original.alias("original")) for i, f in enumerate(self.filters)]
        rows.append(F.struct(F.lit(len(rows) + 1).alias("step"), F.lit("total").alias("filter"),
                             (original - left).alias("removed"), original.alias("original")))
        return counts.select(F.inline(F.array(*rows))).withColumn(
            "removed_share", F.try_divide(F.col("removed"), F.col("original")))


def _run_counts(frame: DataFrame, first: int, run: list[RowFilter]) -> DataFrame:
    """`key, n`: rows entering a run of conditions and rows each of them is the first to drop."""
    tag = F.lit(None).cast("int")
    for i in reversed(range(len(run))):
        tag = F.when(run[i].dropped(frame), F.lit(first + i)).otherwise(tag)
    tagged = frame.select(F.explode(F.array(tag)).alias("tag"))
    names = [f"in{first}", *[f"out{first + i}" for i in range(len(run))]]
    sums = tagged.agg(F.count(F.lit(1)).alias(names[0]), *[
        F.count(F.when(F.col("tag") == first + i, True)).alias(names[i + 1]) for i in range(len(run))])
    return sums.select(F.inline(F.array(*[F.struct(F.lit(n).alias("key"), F.col(n).alias("n")) for n in names])))


def default_chain(min_area: float = 0.5) -> FilterChain:
    """The standard cleaning order of the occurrence files."""
    return (
        FilterChain()
        .add(drop_false_alarms())
        .add(drop_missing_coordinates())
        .add(drop_small_areas(min_area))
        .add(drop_value("QUEIMADA"))
        .add(drop_value("Agrícola"))
    )


def shown_area(column: str = "total_area", min_area: float = schema.MIN_DISPLAY_AREA, keep_null: bool = True) -> Column:
    """Display predicate on the burned area, with or without rows of unknown area."""
    area = F.col(column)
    return (area.isNull() | (area > min_area)) if keep_null else (area > min_area)


def strictly_ordered(start: str, end: str) -> Column:
    """Both timestamps known and the end strictly after the start."""
    return F.col(end) > F.col(start)
