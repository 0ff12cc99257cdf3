"""Dense-vector expressions over ``array<double>`` columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from histwise.functions.exprs import NO_VALUE


def dot(a: Column, b: Column) -> Column:
    """Sum of element products, left to right; NULL if either vector is NULL."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x)


def l2_norm(v: Column) -> Column:
    return F.sqrt(F.aggregate(v, F.lit(0.0), lambda acc, x: acc + x * x))


def cosine(a: Column, b: Column, on_zero: float = NO_VALUE, norms: tuple[Column, Column] | None = None) -> Column:
    """Cosine similarity; ``on_zero`` if a norm is 0; NULL if a vector is missing. ``norms``: those of ``a`` and ``b``
    where they are at hand."""
    na, nb = norms or (l2_norm(a), l2_norm(b))
    return (F.when((na == 0) | (nb == 0), F.lit(on_zero))
             .otherwise(dot(a, b) / na / nb))
