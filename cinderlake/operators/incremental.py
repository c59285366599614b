"""Merging fresh pulls into what is stored: concat-dedup, last write wins, trailing refresh."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cinderlake.session import staged
from cinderlake.sources.sinks import remove_years, stored_years, write_fact


def pick_per_key(df: DataFrame, keys: list[str], order: list[str], last: bool = True) -> DataFrame:
    """The last (or first) row per key by `order`; rows with a NULL key form one group.

    A mergeable maximum of one struct per row, the order first: each task keeps one row per key before
    the shuffle, so a key that many rows share is no heavier than any other, and every column is held
    once. Columns outside the order break its ties.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    ordered = [c for c in order if c not in keys]
    row = ", ".join(f"`{c}`" for c in [*ordered, *rest])
    if not row:
        return df.distinct()
    picked = df.groupBy(*keys).agg(F.expr(f"{'max' if last else 'min'}(struct({row}))").alias("_row"))
    return picked.selectExpr(*[f"`{c}`" if c in keys else f"_row.`{c}` AS `{c}`" for c in df.columns])


def last_write_wins(df: DataFrame, keys: tuple[str, ...] = ("ANO", "original_id"), order: tuple[str, ...] = ("ingest_seq",)) -> DataFrame:
    """One row per key, the latest by an explicit ingest order."""
    return pick_per_key(df, list(keys), list(order))


def concat_dedup(fresh: DataFrame, stored: DataFrame, keys: tuple[str, ...] = ("id",), order: tuple[str, ...] = ()) -> DataFrame:
    """Union of a fresh pull and the stored rows, fresh rows winning on equal keys.

    Within one side the first row by `order` wins, and the remaining columns break ties, so the choice
    does not depend on file order. Keys are unique in the result whether a side is empty or not; the
    original returns the other side as it is when one is empty.
    """
    both = fresh.withColumn("_side", F.lit(0)).unionByName(stored.withColumn("_side", F.lit(1)))
    return pick_per_key(both, list(keys), ["_side", *order], last=False).drop("_side")


def keep_before(df: DataFrame, ts: str, start) -> DataFrame:
    """Rows before `start`, compared as a whole timestamp; rows without a timestamp stay."""
    return df.filter(F.coalesce(F.col(ts) < F.lit(start).cast("timestamp_ntz"), F.lit(True)))


def refresh(
    stored: DataFrame, fresh: DataFrame, start, *, ts: str = "ts", keys: tuple[str, ...] = ("year", "original_id"),
    order: tuple[str, ...] = ("ingest_seq",),
) -> DataFrame:
    """Trailing-window refresh: stored rows before `start` and fresh rows from `start` on.

    Stored rows are one per key already and are only compared with the pull's keys. Running it twice
    with the same pull gives the same rows. A stored row whose key is in the pull is
    replaced even if its time was before `start`.
    """
    window = pick_per_key(fresh.filter(F.col(ts) >= F.lit(start).cast("timestamp_ntz")), list(keys), list(order))
    return without_keys(keep_before(stored, ts, start), window, keys).unionByName(window)


def without_keys(stored: DataFrame, fresh: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Stored rows whose key no fresh row has; NULL keys are compared like values."""
    taken = fresh.select(*[F.col(c).alias(f"_{c}") for c in keys])
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in keys]
    return stored.join(taken, same, "left_anti")


def window_start(today: dt.date, days: int) -> dt.date:
    """First day of a trailing window."""
    return today - dt.timedelta(days=days)


def landed_periods(today: dt.date, days: int) -> list[tuple[int, int, int | None]]:
    """(year, month, day) of the landed pulls a refresh of `days` reads.

    Up to ten days are read day by day, ending yesterday; a longer window as whole months.
    """
    if days <= 10:
        dates = [today - dt.timedelta(days=n) for n in range(1, days + 1)]
        return [(d.year, d.month, d.day) for d in dates]
    first = window_start(today, days)
    months = range(first.year * 12 + first.month - 1, today.year * 12 + today.month)
    return [(m // 12, m % 12 + 1, None) for m in months]


def upsert(
    stored: DataFrame, fresh: DataFrame, keys: list[str], now: Column, created: str = "created_ts", updated: str = "updated_ts"
) -> DataFrame:
    """Fresh rows replace stored rows of the same key.

    A replaced row keeps its first creation time and takes `now` as update time; a new row takes
    `now` for both.
    """
    incoming = fresh.drop(created, updated).withColumn(created, now).withColumn(updated, now)
    both = stored.withColumn("_rank", F.lit(0)).unionByName(incoming.withColumn("_rank", F.lit(1)))
    rest = [c for c in stored.columns if c not in keys and c not in (created, updated)]
    merged = both.groupBy(*keys).agg(F.max(F.struct("_rank", updated, *rest)).alias("_row"), F.min(created).alias(created))
    return merged.select(*[
        F.col(c) if c in keys or c == created else F.col(f"_row.{c}").alias(c) for c in stored.columns])


def backfill(df: DataFrame, source: DataFrame, on: tuple[str, str], columns: list[str]) -> DataFrame:
    """Columns of `source` added to `df` by id; `on` names the id in each."""
    extra = source.select(F.col(on[1]).alias("_sid"), *columns)
    return df.drop(*columns).join(extra, F.col(on[0]) == F.col("_sid"), "left").drop("_sid")


def refresh_table(
    spark: SparkSession, path: str, fresh: DataFrame, start: dt.date, *, year: str = "year", ts: str = "ts",
    keys: tuple[str, ...] = ("year", "original_id"), order: tuple[str, ...] = ("ingest_seq",),
) -> None:
    """Refresh a year-partitioned table in place.

    Only years from `start` on are read and written. The merged rows are staged first, so the table
    is never overwritten while it is read. A year that has become empty is removed.
    """
    stored = spark.read.schema(fresh.schema).parquet(path)
    touched = stored.filter(F.col(year) >= start.year)
    merged = staged(refresh(touched, fresh, start, ts=ts, keys=keys, order=order).select(*fresh.columns), "refresh")
    merged = merged.filter(F.col(year) >= start.year)
    old_years, new_years = stored_years(touched, year), stored_years(merged, year)
    if new_years:
        write_fact(merged, path, year, (ts,))
    remove_years(spark, path, old_years - new_years, year)
