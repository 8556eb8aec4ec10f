"""Statistics: vectors by dimension, entropy, quality roll-ups, data-quality rules."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def vector_stats(df: DataFrame, vector: str, by: Sequence[str] = ()) -> DataFrame:
    """Mean, population deviation, least, largest and number of each dimension: by, dim, mean, std, min, max, n.

    Partial sums are merged, so no vector leaves its task.  Null vectors and
    values that are null or NaN count for nothing.
    """
    each = df.select(*by, F.posexplode(vector).alias("dim", "x")).select(*by, "dim", F.nanvl(F.col("x").cast("double"), F.lit(None).cast("double")).alias("x"))
    return each.groupBy(*by, "dim").agg(
        F.avg("x").alias("mean"), F.stddev_pop("x").alias("std"), F.min("x").alias("min"), F.max("x").alias("max"), F.count("x").alias("n")
    )


def quotient(a: Column, b: Column) -> Column:
    """``a / b`` of doubles by IEEE 754, as SQL over DuckDB gives it: an infinity over zero, NaN for zero over zero."""
    return F.when(b == 0, a * F.pow(b, F.lit(-1.0))).otherwise(a / b)


def entropy(df: DataFrame, label: Column, by: Sequence[str] = ()) -> DataFrame:
    """Shannon entropy in bits of the labels in each ``by``, with their number and that of distinct ones."""
    counts = df.groupBy(*by, label.alias("_label")).agg(F.count(F.lit(1)).alias("c"))
    n = F.sum("c")
    bits = F.log2(n) - F.sum(F.col("c") * F.log2("c")) / n
    return counts.groupBy(*by).agg(F.round(F.abs(bits), 4).alias("entropy"), n.alias("n"), F.count(F.lit(1)).alias("distinct"))


def issues(parts: Sequence[DataFrame]) -> DataFrame:
    """One table of findings: session_id, code, severity, message."""
    return reduce(DataFrame.unionByName, parts)


def issue(df: DataFrame, session: str, code: str, severity: str, when: Column, message: Column) -> DataFrame:
    return df.where(when).select(F.col(session).alias("session_id"), F.lit(code).alias("code"), F.lit(severity).alias("severity"), message.alias("message"))


def reasons(rules: dict[str, Column]) -> Column:
    """The names of the rules that hold, in their order."""
    return F.array_compact(F.array(*[F.when(test, F.lit(name)) for name, test in rules.items()]))


def psnr(a: str, b: str, peak: float = 255.0) -> Column:
    """Of two equally long vectors; infinite if they are the same."""
    error = F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x) / F.size(a)
    return F.when(error <= 1e-9, float("inf")).otherwise(10 * F.log10(peak * peak / error))


def ssim(a: str, b: str, peak: float = 255.0) -> Column:
    """In one window over the whole of two vectors, with population moments."""
    n = F.size(a)
    total = lambda c: F.aggregate(c, F.lit(0.0), lambda s, x: s + x)
    ma, mb = total(F.col(a)) / n, total(F.col(b)) / n
    va = total(F.transform(a, lambda x: x * x)) / n - ma * ma
    vb = total(F.transform(b, lambda x: x * x)) / n - mb * mb
    cov = total(F.zip_with(a, b, lambda x, y: x * y)) / n - ma * mb
    c1, c2 = (0.01 * peak) ** 2, (0.03 * peak) ** 2
    return (2 * ma * mb + c1) * (2 * cov + c2) / ((ma * ma + mb * mb + c1) * (va + vb + c2))


def laplacian_variance(image: str, side: int) -> Column:
    """Population variance of the four-neighbour Laplacian over the inside of a square image in row order."""
    inside = F.array(*[F.lit(r * side + c) for r in range(1, side - 1) for c in range(1, side - 1)])
    at = lambda i: F.get(image, i)
    lap = F.transform(inside, lambda i: at(i - 1) + at(i + 1) + at(i - side) + at(i + side) - 4 * at(i))
    total = lambda c: F.aggregate(c, F.lit(0.0), lambda s, x: s + x)
    n = (side - 2) ** 2
    return total(F.transform(lap, lambda x: x * x)) / n - (total(lap) / n) * (total(lap) / n)
