"""Column expressions over ARRAY<DOUBLE> vectors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EPS = 1e-8


def doubles(vec: Column) -> Column:
    return vec.cast("array<double>")


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x)


def norm(v: Column) -> Column:
    return F.sqrt(F.aggregate(v, F.lit(0.0), lambda acc, x: acc + x * x))


def l2_normalize(v: Column) -> Column:
    """Unit vector; a zero vector stays zero. The length is bound once, outside the element loop."""
    def scaled(n: Column) -> Column:
        return F.transform(v, lambda x: F.when(n > 0, x / n).otherwise(F.lit(0.0)))

    return F.transform(F.array(norm(v)), scaled)[0]


def cosine(a: Column, b: Column, eps: float = EPS) -> Column:
    return dot(a, b) / (norm(a) * norm(b) + F.lit(eps))
