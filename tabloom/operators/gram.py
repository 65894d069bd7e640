"""Weighted Gram matrices of vector columns, and correlations of many columns from them.

The cells of a Gram matrix are sums over rows of w * x_i * x_j. Columns are cut
into blocks; a row goes to one record per pair of blocks, and each record adds
to the block x block sums of its pair. So the number of aggregate expressions
in the plan depends on the block alone, sums are added up map-side, and only
groups x columns^2 numbers are shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK = 16
LINEAR = -1
TOTAL = -2


def _paired(df: DataFrame, size: int, block: int) -> DataFrame:
    """One record per pair of column blocks, with their numbers `__a` <= `__b`."""
    blocks = range(-(-size // block))
    pairs = ", ".join(f"struct({a} AS a, {b} AS b)" for a in blocks for b in blocks if a <= b)
    return df.withColumn("__pair", F.expr(f"explode(array({pairs}))")).selectExpr("*", "__pair.a AS __a", "__pair.b AS __b").drop("__pair")


def _opened(sums: DataFrame, groups: Sequence[str], cells: list[str], names: str) -> DataFrame:
    """The sums of one row as rows; `cells` are the values of a row, `names` those of the columns."""
    return sums.select(*groups, F.expr(f"stack({len(cells)}, {', '.join(cells)}) AS ({names})"))


def gram(
    df: DataFrame,
    vector: str,
    size: int,
    weight: Column,
    linear: Column | None = None,
    totals: Sequence[Column] = (),
    groups: Sequence[str] = (),
    block: int = BLOCK,
) -> DataFrame:
    """(groups, i, j, value): sums of weight * x_i * x_j for i <= j over the rows of each group.

    With `linear`, also rows (i, LINEAR, sum of linear * x_i); for the k-th of
    `totals` a row (k, TOTAL, its sum). A row counts in a cell when all its
    factors are known. `size` is the length of the array column `vector`.
    """
    parts = {"__w": weight, "__l": F.lit(None).cast("double") if linear is None else linear, **{f"__t{k}": t for k, t in enumerate(totals)}}
    rows = df.select(*groups, F.col(vector).alias("__v"), *[v.alias(k) for k, v in parts.items()])
    if size <= block:
        cells = {(i, j): f"__w * __v[{i}] * __v[{j}]" for i in range(size) for j in range(i, size)}
        if linear is not None:
            cells |= {(i, LINEAR): f"__l * __v[{i}]" for i in range(size)}
        cells |= {(k, TOTAL): f"__t{k}" for k in range(len(totals))}
        sums = rows.groupBy(*groups).agg(*[F.expr(f"sum({v}) AS c{n}") for n, v in enumerate(cells.values())])
        return _opened(sums, groups, [f"{i}, {j}, c{n}" for n, (i, j) in enumerate(cells)], "i, j, value")
    x, y = ([f"get(__v, {side} * {block} + {a})" for a in range(block)] for side in ("__a", "__b"))
    i, j = (lambda a: f"__a * {block} + {a}"), (lambda b: f"__b * {block} + {b}")
    cells = {(i(a), j(b)): f"__w * {x[a]} * {y[b]}" for a in range(block) for b in range(block)}
    if linear is not None:
        cells |= {(i(a), str(LINEAR)): f"CASE WHEN __a = __b THEN __l * {x[a]} END" for a in range(block)}
    cells |= {(str(k), str(TOTAL)): f"CASE WHEN __b = 0 THEN __t{k} END" for k in range(len(totals))}
    added = _paired(rows, size, block).groupBy(*groups, "__a", "__b").agg(*[F.expr(f"sum({v}) AS c{n}") for n, v in enumerate(cells.values())])
    opened = _opened(added, [*groups, "__a", "__b"], [f"{a}, {b}, c{n}" for n, (a, b) in enumerate(cells)], "i, j, value")
    square = (F.col("i") <= F.col("j")) & (F.col("j") < size)
    edge = ((F.col("j") == LINEAR) & (F.col("__a") == F.col("__b")) & (F.col("i") < size)) | ((F.col("j") == TOTAL) & (F.col("__b") == 0))
    return opened.filter(square | edge).select(*groups, "i", "j", "value")


def wide_correlations(df: DataFrame, columns: Sequence[str] | str, size: int | None = None, block: int = 8) -> DataFrame:
    """(left, right, corr) for every pair of many numeric columns, left before right, over the rows where both are known.

    `columns` are names, or one array column of length `size` whose slots are
    named by their number. Values are taken off the column means first, so that
    large offsets cost no digits. A constant column, or a pair with fewer than
    two common rows, has a null correlation.
    """
    if isinstance(columns, str):
        names = F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda i: i.cast("string"))
        values = F.col(columns).cast("array<double>")
    else:
        size, names = len(columns), F.array(*[F.lit(c) for c in columns])
        values = F.array(*[F.col(c).cast("double") for c in columns])
    rows = df.select(values.alias("__x"))
    means = rows.select(F.posexplode("__x").alias("i", "v")).groupBy("i").agg(F.avg("v").alias("m"))
    centre = means.agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "m"))), lambda s: s["m"]).alias("c")).scalar()
    rows = rows.withColumn("__c", centre).select(F.zip_with("__x", "__c", lambda x, c: x - c).alias("__x"))
    # unknown values are 0 in x and in its squares, known ones are marked by 1
    known = {"__m": lambda x: F.when(x.isNull(), 0.0).otherwise(1.0), "__q": lambda x: F.coalesce(x * x, F.lit(0.0)), "__x": lambda x: F.coalesce(x, F.lit(0.0))}
    rows = rows.select(*[F.transform("__x", how).alias(name) for name, how in known.items()])
    sums, cells = [], []
    for a in range(block):
        for b in range(block):
            (mx, x, xx), (my, y, yy) = ([f"get({v}, {side} * {block} + {k})" for v in ("__m", "__x", "__q")] for side, k in (("__a", a), ("__b", b)))
            own = [f"{mx} * {my}", f"{x} * {my}", f"{mx} * {y}", f"{xx} * {my}", f"{mx} * {yy}", f"{x} * {y}"]
            own_names = [f"c{len(sums) + k}" for k in range(6)]
            sums += [F.expr(f"sum({v}) AS {name}") for v, name in zip(own, own_names)]
            cells.append(", ".join([f"__a * {block} + {a}", f"__b * {block} + {b}", *own_names]))
    added = _paired(rows, size, block).groupBy("__a", "__b").agg(*sums)
    cells = _opened(added, [], cells, "i, j, n, x, y, xx, yy, xy")
    cells = cells.filter((F.col("i") < F.col("j")) & (F.col("j") < size))
    n = F.col("n")
    spread_x, spread_y = n * F.col("xx") - F.col("x") * F.col("x"), n * F.col("yy") - F.col("y") * F.col("y")
    noise = 1e-12 * n
    varies = (n > 1) & (spread_x > noise * F.col("xx")) & (spread_y > noise * F.col("yy"))
    corr = F.when(varies, (n * F.col("xy") - F.col("x") * F.col("y")) / F.sqrt(spread_x * spread_y))
    named = cells.withColumn("__names", names)
    return named.select(F.get("__names", F.col("i")).alias("left"), F.get("__names", F.col("j")).alias("right"), corr.alias("corr"))
