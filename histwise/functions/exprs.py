"""Scalar expressions used by the features."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The place weights of the ten most recent outcomes in seq2vec
# (the most recent outcome has weight 1, the next 0.1, ...).
SEQ2VEC_WEIGHTS = [1.0, 0.1, 0.01, 0.001, 0.0001, 0.00001, 0.000001, 0.0000001,
                   0.00000001, 0.000000001]

# Sentinels of the reference.
ZERO_ACCURACY_WEIGHT = 999.0
NO_VALUE = -999.0


def ratio(num: Column, den: Column) -> Column:
    """``num / den`` as double; NULL when ``den`` is 0 or NULL (never raises)."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def flag(cond: Column) -> Column:
    """1 when ``cond`` is true, else 0 (NULL counts as false), as int."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def odds_weight(acc: Column, cap: float = ZERO_ACCURACY_WEIGHT) -> Column:
    """Odds of failure ``(1 - acc) / acc``; ``cap`` when ``acc`` is 0; NULL stays NULL."""
    return F.when(acc == 0, F.lit(cap)).otherwise((F.lit(1.0) - acc) / acc)


def change_rate(prev: Column, cur: Column, on_zero: float = NO_VALUE) -> Column:
    """Relative change ``(prev - cur) / cur``; ``on_zero`` when ``cur`` is 0."""
    return F.when(cur == 0, F.lit(on_zero)).otherwise((prev - cur) / cur)


def seq2vec(lags: list[Column]) -> Column:
    """Decimal-digit code of recent outcomes: sum_i w_i * coalesce(lag_i, 0).

    Summed left to right, most recent first, exactly like the reference.
    """
    terms = [F.lit(w) * F.coalesce(c, F.lit(0)).cast("double")
             for w, c in zip(SEQ2VEC_WEIGHTS, lags)]
    return reduce(lambda a, b: a + b, terms)
