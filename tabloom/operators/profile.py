"""Profiling of flat tables: completeness, summaries, frequencies, shapes."""

from __future__ import annotations

import math
from collections.abc import Sequence
from itertools import combinations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabloom.operators.grouping import numeric_columns, unpivot
from tabloom.operators.ranking import value_buckets


def _spread(row: DataFrame, names: Sequence[str], values: dict[str, list[str]]) -> DataFrame:
    """One wide row to one row per name; `values` maps output names to the wide columns."""
    entries = [
        F.struct(F.lit(n).alias("column"), *[F.col(f"`{cols[i]}`").alias(k) for k, cols in values.items()])
        for i, n in enumerate(names)
    ]
    return row.select(F.inline(F.array(*entries)))


def non_null(df: DataFrame) -> DataFrame:
    """column, type, non_null: what a schema summary shows. One pass."""
    row = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns])
    types = dict(df.dtypes)
    kind = F.lit("")
    for c in df.columns:
        kind = F.when(F.col("column") == c, types[c]).otherwise(kind)
    counts = _spread(row, df.columns, {"non_null": df.columns})
    return counts.select("column", kind.alias("type"), "non_null")


def null_fraction(df: DataFrame) -> DataFrame:
    """column, null_fraction: share of null cells. One pass."""
    row = df.agg(*[F.avg(F.col(f"`{c}`").isNull().cast("int")).alias(c) for c in df.columns])
    return _spread(row, df.columns, {"null_fraction": df.columns})


def column_range(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """column, low, high."""
    row = df.agg(
        *[F.min(c).cast("double").alias(f"lo_{c}") for c in columns],
        *[F.max(c).cast("double").alias(f"hi_{c}") for c in columns],
    )
    return _spread(row, columns, {"low": [f"lo_{c}" for c in columns], "high": [f"hi_{c}" for c in columns]})


def quantiles(df: DataFrame, columns: Sequence[str], shares: Sequence[float], parts: int | None = None) -> DataFrame:
    """column, share, value: exact quantiles with linear interpolation.

    Bucket sizes tell which buckets hold the wanted ranks; only their values
    are counted and ranked.
    """
    names = [f"x{k}" for k in range(len(columns))]
    numbers = df.select(*[F.col(c).cast("double").alias(x) for c, x in zip(columns, names)])
    bounds = value_buckets(numbers, names, parts)
    cutter = Bucketizer(splitsArray=[bounds[x] for x in names], inputCols=names, outputCols=[f"{x}_bucket" for x in names], handleInvalid="keep")
    parts_of = [F.struct(F.lit(c).alias("column"), F.col(x).alias("value"), F.col(f"{x}_bucket").alias("bucket")) for c, x in zip(columns, names)]
    cells = cutter.transform(numbers).select(F.inline(F.array(*parts_of))).filter(F.col("value").isNotNull())  # one scan for all columns
    column = Window.partitionBy("column")
    earlier = column.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = cells.groupBy("column", "bucket").agg(F.count(F.lit(1)).alias("n")).select(
        "column",
        "bucket",
        "n",
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"),
        F.sum("n").over(column).alias("total"),
    )
    spots = F.array(
        *[F.struct(F.lit(s).alias("share"), (F.lit(s) * (F.col("total") - 1)).alias("place")) for s in shares]
    )

    def inside(low: Column, n: Column):
        """Places whose lower or upper rank lies in ranks low..low + n - 1, counted from 0."""
        return lambda p: (low <= F.ceil(p["place"])) & (F.floor(p["place"]) < low + n)

    wanted = sizes.select(
        "column", "bucket", "before", F.filter(spots, inside(F.col("before"), F.col("n"))).alias("places")
    ).filter(F.size("places") > 0)
    counted = (
        cells.join(F.broadcast(wanted), ["column", "bucket"])  # at most two buckets per column and share
        .groupBy("column", "bucket", "before", "places", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    running = Window.partitionBy("column", "bucket").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    ranked = counted.withColumn("last", F.col("before") + F.sum("n").over(running))
    first = F.col("last") - F.col("n")
    pick = ranked.select(
        "column",
        "value",
        first.alias("first"),
        "last",
        F.inline(F.filter("places", inside(first, F.col("n")))),
    ).withColumns({"low_rank": F.floor("place"), "high_rank": F.ceil("place")})

    def at(rank: str):
        return F.max(F.when((F.col("first") <= F.col(rank)) & (F.col(rank) < F.col("last")), F.col("value")))

    return (
        pick.groupBy("column", "share", "place")
        .agg(at("low_rank").alias("low"), at("high_rank").alias("high"))
        .select(
            "column",
            "share",
            (F.col("low") + (F.col("high") - F.col("low")) * (F.col("place") - F.floor("place"))).alias("value"),
        )
    )


def describe(df: DataFrame, columns: Sequence[str] | None = None, approximate: bool = False) -> DataFrame:
    """column, count, mean, std, min, q25, q50, q75, max of the numeric columns.

    `approximate` replaces the exact quartiles with sketches inside the one
    aggregate pass.
    """
    columns = list(columns or numeric_columns(df))
    wanted = {
        "count": F.count,
        "mean": F.avg,
        "std": F.stddev_samp,
        "min": lambda c: F.min(c).cast("double"),
        "max": lambda c: F.max(c).cast("double"),
    }
    shares = [0.25, 0.5, 0.75]
    if approximate:
        wanted["quarters"] = lambda c: F.percentile_approx(c, shares).cast("array<double>")
    row = df.agg(*[make(c).alias(f"{k}_{c}") for k, make in wanted.items() for c in columns])
    summary = _spread(row, columns, {k: [f"{k}_{c}" for c in columns] for k in wanted})
    if approximate:
        summary = summary.withColumns({n: F.col("quarters")[i] for i, n in enumerate(("q25", "q50", "q75"))})
    else:
        quarters = quantiles(df, columns, shares)
        wide = quarters.groupBy("column").agg(
            *[
                F.max(F.when(F.col("share") == share, F.col("value"))).alias(name)
                for name, share in (("q25", 0.25), ("q50", 0.5), ("q75", 0.75))
            ]
        )
        summary = summary.join(wide, "column", "left")
    return summary.select("column", "count", "mean", "std", "min", "q25", "q50", "q75", "max")


def shape(df: DataFrame) -> DataFrame:
    """rows, columns."""
    return df.agg(F.count(F.lit(1)).alias("rows")).withColumn("columns", F.lit(len(df.columns)))


def duplicate_rows(df: DataFrame, chunk: int = 100_000) -> DataFrame:
    """All occurrences of a row after its first.

    Equal rows are counted (reduced before the shuffle) and written out again
    n - 1 times. The copies are cut into chunks that are spread over tasks, so
    a row that makes up much of the table does not fill one of them.
    """
    counted = df.groupBy(*df.columns).agg((F.count(F.lit(1)) - 1).alias("__n")).filter("__n > 0")
    chunks = (
        counted.withColumn("__chunk", F.explode(F.sequence(F.lit(0), F.floor((F.col("__n") - 1) / chunk))))
        .withColumn("__left", F.least(F.col("__n") - F.col("__chunk") * chunk, F.lit(chunk)).cast("int"))
        .repartition("__chunk", *df.columns)
    )
    return chunks.select(*df.columns, F.explode(F.sequence(F.lit(1), F.col("__left"))).alias("__i")).drop("__i")


def drop_duplicates(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def category_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """column, value, count for many category columns in one pass."""
    return unpivot(df, columns, "string").groupBy("column", "value").agg(F.count(F.lit(1)).alias("count"))


def category_by_label(df: DataFrame, columns: Sequence[str], label: str) -> DataFrame:
    """column, value, label, count."""
    cells = unpivot(df, columns, "string", [F.col(label).alias("label")])
    return cells.groupBy("column", "value", "label").agg(F.count(F.lit(1)).alias("count"))


def correlations(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """left, right, corr for every pair of numeric columns, in one aggregate pass."""
    columns = list(columns or numeric_columns(df))
    pairs = list(combinations(columns, 2))
    row = df.agg(
        *[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"r{i}") for i, (a, b) in enumerate(pairs)]
    )
    entries = [
        F.struct(F.lit(a).alias("left"), F.lit(b).alias("right"), F.col(f"r{i}").alias("corr"))
        for i, (a, b) in enumerate(pairs)
    ]
    upper = row.select(F.inline(F.array(*entries)))
    return upper


def correlation_matrix(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """The full square: both triangles and the ones on the diagonal."""
    columns = list(columns or numeric_columns(df))
    upper = correlations(df, columns)
    both = upper.select(
        F.inline(
            F.array(
                F.struct("left", "right", "corr"),
                F.struct(F.col("right").alias("left"), F.col("left").alias("right"), "corr"),
            )
        )
    )
    ones = [F.struct(F.lit(c).alias("left"), F.lit(c).alias("right"), F.lit(1.0).alias("corr")) for c in columns]
    diagonal = df.agg(F.count(F.lit(1)).alias("n")).select(F.inline(F.array(*ones)))
    return both.unionByName(diagonal)


def sturges(rows: int) -> int:
    """Number of histogram bins for `rows` values."""
    return max(1, math.ceil(math.log2(max(rows, 1))) + 1)


def _limits(df: DataFrame, column: str):
    """Scalar subqueries: lowest and highest value and number of values."""
    stats = df.agg(
        F.struct(
            F.min(F.col(column).cast("double")).alias("low"),
            F.max(F.col(column).cast("double")).alias("high"),
            F.count(column).alias("n"),
            F.stddev_samp(column).alias("std"),
        )
    ).scalar()
    return stats["low"], stats["high"], stats["n"], stats["std"]


def histogram(df: DataFrame, column: str, bins: int | None = None) -> DataFrame:
    """bin, low, count, density: equal-width bins, density = count / (n * width); bins without rows have count 0.

    Bins default to Sturges' rule. The limits come from a scalar subquery, so
    the whole thing is one lazy plan.
    """
    low, high, n, _ = _limits(df, column)
    count = F.lit(bins) if bins else F.greatest(F.ceil(F.log2(n)) + 1, F.lit(1))
    numbers = df.filter(F.col(column).isNotNull()).select(
        F.col(column).cast("double").alias("x"), low.alias("lo"), ((high - low) / count).alias("width"),
        count.alias("bins"), n.alias("n"),
    )
    place = F.when(F.col("width") == 0, F.lit(0)).otherwise(
        F.least(F.floor((F.col("x") - F.col("lo")) / F.col("width")), F.col("bins") - 1)
    )
    counted = numbers.groupBy(place.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    one = df.agg(F.min(column).cast("double").alias("lo"), F.max(column).cast("double").alias("hi"), F.count(column).alias("n"))
    every = one.withColumn("bins", F.lit(bins) if bins else F.greatest(F.ceil(F.log2("n")) + 1, F.lit(1))).filter("n > 0")
    grid = every.withColumn("width", (F.col("hi") - F.col("lo")) / F.col("bins")).withColumn(
        "bin", F.explode(F.sequence(F.lit(0), F.when(F.col("width") == 0, 0).otherwise(F.col("bins") - 1).cast("int")))
    )
    filled = grid.join(counted, "bin", "left").withColumn("count", F.coalesce("count", F.lit(0).cast("bigint")))
    return filled.select(
        "bin",
        (F.col("lo") + F.col("bin") * F.col("width")).alias("low"),
        "count",
        F.when(F.col("width") > 0, F.col("count") / (F.col("n") * F.col("width"))).alias("density"),
    )


def kernel_density(df: DataFrame, column: str, points: int = 50) -> DataFrame:
    """grid_no, x, density: Gaussian kernel, Scott's bandwidth std * n^(-1/5).

    The exact sum: one aggregate with a term per grid point, linear in the rows.
    """
    low, high, n, std = _limits(df, column)
    h = std * F.pow(n.cast("double"), F.lit(-0.2))
    numbers = df.filter(F.col(column).isNotNull()).select(
        F.col(column).cast("double").alias("x"), low.alias("lo"), high.alias("hi"), n.alias("n"), h.alias("h")
    )

    def at(k: int) -> Column:
        return F.col("lo") + F.lit(k) * (F.col("hi") - F.col("lo")) / (points - 1)

    def mass(k: int) -> Column:
        z = (at(k) - F.col("x")) / F.col("h")
        return F.sum(F.exp(-0.5 * z * z))

    sums = numbers.groupBy("lo", "hi", "n", "h").agg(*[mass(k).alias(f"m{k}") for k in range(points)])
    grid = F.array(*[F.struct(F.lit(k).alias("grid_no"), at(k).alias("x"), F.col(f"m{k}").alias("mass")) for k in range(points)])
    return sums.select("n", "h", F.inline(grid)).select(
        "grid_no",
        "x",
        (F.col("mass") / (F.col("n") * F.col("h") * math.sqrt(2 * math.pi))).alias("density"),
    )
