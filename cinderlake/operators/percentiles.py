"""Exact interpolated percentiles, by one path for groups of every size.

Spark's built-in exact percentile keeps a map of every distinct value of a group in one task. Here a
group costs little more than its number of wanted points, however large it is and however its values
are spread:

1. a mergeable sketch per group (`percentile_approx`, whose rank error is bounded) brackets each
   wanted rank by two values of the group, with exact count, minimum, maximum and sum beside it;
2. one aggregate turns the rows into a profile: rows outside all brackets are counted by where they
   lie, rows inside by value. It is combined on the map side, so what is shuffled is the few values of
   the brackets and a handful of counts from each task;
3. running totals over the profile of a group give the rank of each of its values, and so the values
   at the two ranks that are interpolated.

A bracket holds at most about 12 in `ACCURACY` of a large group's rows and repeated values are one row of the
profile, so neither a hot group nor a narrow range of values makes a hot task. The result is
`low + (high - low) * fraction` of two values of the data, the same however the rows are partitioned.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinderlake.session import staged

ACCURACY = 10_000
# Half the width of a bracket, in ranks over the group's size: the sketch's error with some room, and
# wider ones for small groups, whose bracket has to reach the next ranks.
MARGIN = 4 / ACCURACY
MARGINS = (MARGIN, 0.002, 0.01, 0.05, 0.25, 1.0)


def _listed(keys: list[str], alias: str | None = None) -> str:
    prefix = f"{alias}." if alias else ""
    return ", ".join(f"{prefix}`{key}`" for key in keys)


def _same(keys: list[str], left: str, right: str) -> str:
    """Null-safe equality: a group whose key is NULL is a group like any other."""
    return " AND ".join(f"{left}.`{key}` <=> {right}.`{key}`" for key in keys)


def measured(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """`keys, value` as double; NULL and NaN values are left out."""
    rows = df.select(*keys, F.col(value).cast("double").alias("value"))
    return rows.filter(F.col("value").isNotNull() & ~F.isnan("value"))


def exact_percentiles(
    df: DataFrame, keys: list[str], value: str, points: dict[str, float], *, low: str | None = None,
    high: str | None = None, total: str | None = None,
) -> DataFrame:
    """Interpolated percentiles of `value` per group; `points` maps output names to fractions."""
    rows, k, spark = measured(df, keys, value), _listed(keys), df.sparkSession
    edges = ", ".join(f"{max(0.0, p - m)}D, {min(1.0, p + m)}D" for p in points.values() for m in MARGINS)
    fitting = "CASE " + " ".join(f"WHEN {m}D * size >= 3 THEN {j}" for j, m in enumerate(MARGINS[:-1])) + f" ELSE {len(MARGINS) - 1} END"
    spans = list(enumerate(points.values()))

    def rank(p: float, rounding: str) -> str:
        return f"{rounding}({float(p)}D * (size - 1))"

    # Where a value lies: below the bracket of each point (0), inside (1) or above it (2).
    place = ", ".join(
        f"CASE WHEN value < at[{2 * i * len(MARGINS)} + 2 * width] THEN 0 WHEN value <= at[{2 * i * len(MARGINS) + 1} + 2 * width] THEN 1 ELSE 2 END"
        for i, _ in spans)
    inside = " OR ".join(f"place[{i}] = 1" for i, _ in spans)
    starts = ", ".join(
        f"sum(CASE WHEN place[{i}] < 1 THEN n ELSE 0 END) OVER (PARTITION BY {k})"
        f" + sum(CASE WHEN place[{i}] = 1 THEN n ELSE 0 END) OVER (PARTITION BY {k} ORDER BY inner ROWS UNBOUNDED PRECEDING) - n AS first{i}"
        for i, _ in spans)
    ends = ", ".join(
        f"max(CASE WHEN place[{i}] = 1 AND {rank(p, r)} >= first{i} AND {rank(p, r)} < first{i} + n THEN inner END) AS {r}{i}"
        for i, p in spans for r in ("floor", "ceil"))
    blended = ", ".join(
        f"CASE WHEN floor{i} = ceil{i} THEN floor{i} ELSE floor{i} + (ceil{i} - floor{i}) * ({float(p)}D * (size - 1) - {rank(p, 'floor')}) END AS `{name}`"
        for (i, p), name in zip(spans, points, strict=True))
    extra = "".join(f", {c} AS `{n}`" for c, n in (("lo", low), ("hi", high), ("s", total)) if n)
    return spark.sql(f"""
        WITH sketches AS (
          SELECT {k}, percentile_approx(value, array({edges}), {ACCURACY}) AS at, count(*) AS size,
                 min(value) AS lo, max(value) AS hi, sum(value) AS s
          FROM {{rows}} GROUP BY {k}
        ),
        brackets AS (SELECT *, {fitting} AS width FROM sketches),
        placed AS (
          SELECT {_listed(keys, "r")}, b.size, b.lo, b.hi, b.s, r.value, array({place}) AS place
          FROM {{rows}} r JOIN brackets b ON {_same(keys, "r", "b")}
        ),
        profile AS (
          SELECT {k}, place, CASE WHEN {inside} THEN value END AS inner, count(*) AS n,
                 max(size) AS size, max(lo) AS lo, max(hi) AS hi, max(s) AS s
          FROM placed GROUP BY {k}, place, CASE WHEN {inside} THEN value END
        ),
        ranked AS (SELECT *, {starts} FROM profile),
        found AS (SELECT {k}, {ends}, max(size) AS size, max(lo) AS lo, max(hi) AS hi, max(s) AS s FROM ranked GROUP BY {k})
        SELECT {k}, {blended}{extra} FROM found""", rows=rows)


def approximate_percentiles(
    df: DataFrame, keys: list[str], value: str, points: dict[str, float], accuracy: int = ACCURACY
) -> DataFrame:
    """Opt-in single-pass form; the rank error is at most one part in `accuracy`."""
    out = df.groupBy(*keys).agg(
        F.percentile_approx(value, list(points.values()), accuracy).alias("_p"))
    return out.select(*keys, *[F.get("_p", F.lit(i)).alias(n) for i, n in enumerate(points)])


def trimmed_percentiles(
    df: DataFrame, keys: list[str], value: str, points: dict[str, float], *,
    spread: float | None = 1.5, upper: float | None = None, low: str = "min", high: str = "max",
) -> DataFrame:
    """Percentiles after outliers are cut per group, computed again on what is left.

    Values below `p25 - spread * (p75 - p25)` are cut, and above the mirrored limit, or above the
    fixed `upper` when that is given. `spread=None` cuts nothing. Groups with a NULL key take no
    part when values are cut, as their limits are looked up by key.
    """
    if spread is None:
        return exact_percentiles(df, keys, value, points, low=low, high=high)
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    # Read four times below; two or three narrow columns are cheaper than four times the joins above.
    rows = staged(measured(df, keys, value).filter(known), "measured")
    quarts = exact_percentiles(rows, keys, "value", {"q1": 0.25, "q3": 0.75})
    margin = f"{float(spread)}D * (q3 - q1)"
    ceiling = f"{float(upper)}D" if upper is not None else f"q3 + {margin}"
    kept = rows.join(staged(quarts, "quartiles"), keys).filter(f"value BETWEEN q1 - {margin} AND {ceiling}")
    return exact_percentiles(kept.select(*keys, "value"), keys, "value", points, low=low, high=high)
