"""History windows over an event log.

All windows order rows by ``(timestamp, row_id)``: the reference orders by
``timestamp`` alone, which leaves ROWS frames, LAG and ROW_NUMBER ambiguous
on ties; the unique ``row_id`` makes them deterministic.

Frames that end at ``1 PRECEDING`` are the leak guard: a row never sees its
own outcome. An empty frame gives NULL (``SUM``), not 0.

Every helper returns a ``Column``; windows that share partition and order
keys are evaluated by one Window operator after one sort, and all keys here
start with ``user_id`` so one hash exchange on ``user_id`` serves them all.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, Window, WindowSpec
from pyspark.sql import functions as F

ORDER = ("timestamp", "row_id")


def _cols(names: Sequence[str] | str) -> list[str]:
    return [names] if isinstance(names, str) else list(names)


def ordered(by: Sequence[str] | str, order: Sequence[str] = ORDER) -> WindowSpec:
    return Window.partitionBy(*_cols(by)).orderBy(*order)


def running_sum(value: Column, by, order: Sequence[str] = ORDER,
                include_current: bool = False) -> Column:
    """Sum over all earlier rows of the group."""
    end = Window.currentRow if include_current else -1
    return F.sum(value).over(ordered(by, order).rowsBetween(Window.unboundedPreceding, end))


def running_count(by, order: Sequence[str] = ORDER, include_current: bool = False) -> Column:
    """``SUM(1)`` over earlier rows: NULL (not 0) on the first row of a group."""
    return running_sum(F.lit(1).cast("long"), by, order, include_current)


def lag_of(value: Column | str, by, n: int = 1, order: Sequence[str] = ORDER) -> Column:
    """Value ``n`` rows back in the group."""
    return F.lag(value, n).over(ordered(by, order))


# --- declared window needs ------------------------------------------------------------------
from dataclasses import dataclass, field, replace  # noqa: E402


@dataclass
class Spec:
    """Window columns wanted over one key family, ordered by ``(timestamp, row_id)``.

    ``count_before``  SUM(1) over earlier rows (NULL on the first row)
    ``count_incl``    SUM(1) up to and including the row
    ``sums_before``   SUM(value) over earlier rows
    ``lags``          value ``d`` rows back: name -> (column, d)
    ``slides``        SUM(value) over the ``width`` rows before: name -> (value, width)
    ``slide_counts``  SUM(1) over the ``width`` rows before: name -> width
    ``weighted``      the sums above whose values are item weights, or 0 in their place
    ``never_null``    the sums above whose values are never NULL
    """

    key: tuple[str, ...]
    count_before: list[str] = field(default_factory=list)
    count_incl: list[str] = field(default_factory=list)
    sums_before: dict = field(default_factory=dict)
    lags: dict = field(default_factory=dict)
    slides: dict = field(default_factory=dict)
    slide_counts: dict = field(default_factory=dict)
    weighted: frozenset = frozenset()
    never_null: frozenset = frozenset()

    def merge(self, other: "Spec") -> "Spec":
        if other.key != self.key:
            raise ValueError("different keys")
        return Spec(self.key,
                    sorted(set(self.count_before) | set(other.count_before)),
                    sorted(set(self.count_incl) | set(other.count_incl)),
                    {**self.sums_before, **other.sums_before},
                    {**self.lags, **other.lags},
                    {**self.slides, **other.slides},
                    {**self.slide_counts, **other.slide_counts}, self.weighted | other.weighted,
                    self.never_null | other.never_null)

    def outputs(self) -> list[str]:
        return (list(self.count_before) + list(self.count_incl) + list(self.sums_before)
                + list(self.lags) + list(self.slides) + list(self.slide_counts))


def merge_specs(specs) -> list[Spec]:
    """One Spec per key, in first-seen key order."""
    out: dict = {}
    for s in specs:
        out[s.key] = out[s.key].merge(s) if s.key in out else s
    return list(out.values())


INTEGRAL = ("tinyint", "smallint", "int", "bigint", "boolean")
FLOATING = ("float", "double")

# Exact sums of floating values. A value is cut into whole multiples of 2**e for falling exponents e, DIGIT_BITS
# apart, down to its own last bit; each digit is a long of at most that many bits, so 2**33 of them add up
# without loss, and the sums of different blocks, frames or paths are the same whole numbers.
DIGIT_BITS = 30
MANTISSA_BITS = 53
# Exponents of the largest and of the smallest normal double.
MAX_EXPONENT, MIN_EXPONENT = 1023, -1022


def digit_exponents(smallest: float | None, largest: float | None) -> list[int]:
    """The exponents e for values whose magnitude is 0 or between ``smallest`` and ``largest``, falling."""
    if not largest:
        return []
    top = math.frexp(largest)[1]
    low = max(math.frexp(smallest)[1] - MANTISSA_BITS, MIN_EXPONENT)
    count = max(1, -(-(top - low) // DIGIT_BITS))
    return [low + DIGIT_BITS * k for k in reversed(range(count))]


def digits(value: Column, exponents: Sequence[int]) -> list[Column]:
    """The digits of ``value``, each a long; 0 where it is NULL. A digit is what cutting off at its exponent leaves
    beyond cutting off at the one before; cutting off and subtracting are without rounding."""
    v = F.coalesce(value.cast("double"), F.lit(0.0))
    out, above = [], None
    for e in exponents:
        cut = (v * F.lit(2.0 ** -e)).cast("long").cast("double") * F.lit(2.0 ** e)
        if e + MANTISSA_BITS <= MAX_EXPONENT:       # a value that large has no bits below
            cut = F.when(F.abs(v) >= F.lit(2.0 ** (e + MANTISSA_BITS)), v).otherwise(cut)
        out.append(((cut if above is None else cut - above) * F.lit(2.0 ** -e)).cast("long"))
        above = cut
    return out


def from_digits(sums: Sequence[Column], exponents: Sequence[int]) -> Column:
    """The value of digit sums, smallest first, so that little is rounded and the largest last."""
    total = F.lit(0.0)
    for s, e in zip(reversed(sums), reversed(list(exponents))):
        total = total + s.cast("double") * F.lit(2.0 ** e)
    return total


def value_bounds(frame, values: Sequence[Column]) -> list[tuple[float | None, float | None]]:
    """Smallest non-zero and largest magnitude of each value, in one pass over ``frame``."""
    size = [F.abs(v.cast("double")) for v in values]
    row = frame.agg(*[x for i, m in enumerate(size) for x in (F.min(F.when(m > 0, m)).alias(f"s{i}"), F.max(m).alias(f"l{i}"))]).first()
    return [(row[f"s{i}"], row[f"l{i}"]) for i in range(len(size))]


def exact_spec(frame, spec: "Spec", bounds: dict | None = None):
    """``spec`` with every floating sum as sums of digits: (frame with the digits, spec of whole numbers, finish),
    where ``finish`` puts the floating columns together. ``bounds``: value column -> (smallest, largest)
    magnitude where the caller knows them; other values are looked at in one pass over ``frame``."""
    wanted = [("sums_before", n, v, None) for n, v in spec.sums_before.items()] + [("slides", n, v, w) for n, (v, w) in spec.slides.items()]
    if not wanted:
        return frame, spec, lambda f: f
    types = frame.select(*[v.alias(f"_v{i}") for i, (_, _, v, _) in enumerate(wanted)]).schema
    floating = [x for x, t in zip(wanted, types) if t.dataType.simpleString() in FLOATING]
    if not floating:
        return frame, spec, lambda f: f
    known = {n: (bounds or {}).get(n) for _, n, _, _ in floating}
    unknown = [(n, v) for _, n, v, _ in floating if known[n] is None]
    if unknown:
        known.update(zip([n for n, _ in unknown], value_bounds(frame, [v for _, v in unknown])))
    sums = {n: v for n, v in spec.sums_before.items()}
    slides = {n: v for n, v in spec.slides.items()}
    added, made = {}, {}
    for kind, n, v, width in floating:
        exponents = digit_exponents(*known[n]) or [0]
        names = [f"_digit_{n}_{k}" for k in range(len(exponents))] + [f"_digit_{n}_values"]
        added.update(zip(names, [*digits(v, exponents), v.isNotNull().cast("long")]))
        if kind == "slides":
            del slides[n]
            slides.update({f"{d}_sum": (F.col(d), width) for d in names})
        else:
            del sums[n]
            sums.update({f"{d}_sum": F.col(d) for d in names})
        there = F.col(f"{names[-1]}_sum") > 0
        made[n] = (F.when(there, from_digits([F.col(f"{d}_sum") for d in names[:-1]], exponents)), [f"{d}_sum" for d in names])

    def finish(f):
        gone = list(added) + [c for _, cols in made.values() for c in cols]
        return f.withColumns({n: c for n, (c, _) in made.items()}).drop(*gone)

    whole = replace(spec, sums_before=sums, slides=slides, never_null=frozenset(f"{d}_sum" for d in added))
    return frame.withColumns(added), whole, finish


def evaluate(frame, spec: Spec, order: Sequence[str] = ORDER):
    """Plain window evaluation, all keyed by ``spec.key`` (one exchange, one sort per key).

    Sums are of whole numbers (``exact_spec`` makes them so for floating values). Sliding sums are
    differences of prefix sums read through a ``lag``: O(1) work per row instead of re-summing
    a ``width``-row frame for every row. Frames holding only NULLs stay NULL.
    """
    by = list(spec.key)
    if spec.slides:
        w = ordered(by, order)
        before = w.rowsBetween(Window.unboundedPreceding, -1)
        prefix, outs = {}, {}
        for i, (n, (v, width)) in enumerate(spec.slides.items()):
            prefix[f"_spb{i}"] = F.sum(F.coalesce(v.cast("long"), F.lit(0).cast("long"))).over(before)
            s = F.col(f"_spb{i}") - F.coalesce(F.lag(f"_spb{i}", width).over(w), F.lit(0).cast("long"))
            if n in spec.never_null:
                outs[n] = s
                continue
            prefix[f"_scb{i}"] = F.sum(v.isNotNull().cast("long")).over(before)
            c = F.col(f"_scb{i}") - F.coalesce(F.lag(f"_scb{i}", width).over(w), F.lit(0).cast("long"))
            outs[n] = F.when(c > 0, s)
        frame = frame.withColumns(prefix).withColumns(outs).drop(*prefix)
    cols = {}
    for n in spec.count_before:
        cols[n] = running_count(by, order)
    for n in spec.count_incl:
        cols[n] = running_count(by, order, include_current=True)
    for n, v in spec.sums_before.items():
        cols[n] = running_sum(v, by, order)
    for n, (c, d) in spec.lags.items():
        cols[n] = lag_of(c, by, d, order)
    for n, width in spec.slide_counts.items():
        n_before = running_count(by, order)
        cols[n] = F.when(n_before.isNotNull(), F.least(n_before, F.lit(width).cast("long")))
    return frame.withColumns(cols) if cols else frame
