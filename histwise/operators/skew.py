"""Skew-safe history windows for very large groups (hot users).

A window partitioned by ``user_id`` sends all of a user's rows to one task.
When one user holds a large share of the log that task becomes the job.
This module splits such groups without changing any result:

1. ``hot_keys``      counts rows per key with a map-side combined aggregate and
                     keeps the keys above a threshold. There are at most
                     ``rows / threshold`` of them, so the list has a proven size
                     bound before it is broadcast for the semi/anti split.
2. ``assign_blocks`` range-partitions the hot rows on ``(key, order)`` into
                     blocks of about ``block_rows`` rows; a user's history is
                     cut into consecutive, ordered blocks. A ``checkpoint`` to
                     the shared checkpoint folder freezes the block ids (and cuts
                     lineage), so every later branch sees the same blocks.
3. ``evaluate_blocked`` computes every column of a :class:`Spec` from
   * block-local running windows over ``(key, block)`` (bounded tasks),
   * per-block totals turned into offsets by a window over the (small)
     block table, giving each row its global position and prefix sums,
   * lags and sliding frames by an equi-join on ``(key, position - d)``:
     each row is copied once per distance ``d`` it must feed, so hash
     partitioning on ``(key, position)`` spreads a hot key over all tasks.

Sliding sums become differences of prefix sums of whole numbers; floating values come
as digits that are whole numbers (``windows.exact_spec``), so sums of blocks add up without loss.
Empty frames and frames of only NULLs stay NULL, as in SQL.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from histwise.operators.windows import ORDER, Spec
from histwise.session import ensure_checkpoint_dir


@dataclass(frozen=True)
class SkewPolicy:
    """When a key counts as hot and how its rows are cut."""

    max_rows_per_key: int = 5_000_000   # above this a user's history is split into blocks
    block_rows: int = 1_000_000         # target rows per block
    max_hot_keys: int = 1_000_000       # broadcast bound for the hot-key list

    def blocks_for(self, rows: int) -> int:
        return max(1, -(-rows // self.block_rows))


@dataclass(frozen=True)
class HotSplit:
    """Hot keys (a small DataFrame, broadcast when under the cap) and their size."""

    keys: DataFrame
    n_keys: int
    n_rows: int
    n_blocks: int


def hot_keys(df: DataFrame, key: Sequence[str], policy: SkewPolicy) -> HotSplit | None:
    """Keys with more than ``policy.max_rows_per_key`` rows (checkpointed), or None."""
    counts = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"))
    hot = counts.where(F.col("_n") > policy.max_rows_per_key)
    ensure_checkpoint_dir(df.sparkSession)
    hot = hot.checkpoint(eager=True)
    stats = hot.agg(F.count(F.lit(1)).alias("k"), F.sum("_n").alias("rows")).first()
    n_keys, n_rows = int(stats["k"]), int(stats["rows"] or 0)
    if n_keys == 0:
        return None
    keys = hot.select(*key)
    # The list is bounded by rows / max_rows_per_key; broadcast only below the cap.
    keys = F.broadcast(keys) if n_keys <= policy.max_hot_keys else keys
    return HotSplit(keys, n_keys, n_rows, policy.blocks_for(n_rows))


def split(df: DataFrame, keys: DataFrame | None, key: Sequence[str]) -> tuple[DataFrame, DataFrame | None]:
    """(rows of cold keys, rows of hot keys)."""
    if keys is None:
        return df, None
    return df.join(keys, list(key), "left_anti"), df.join(keys, list(key), "left_semi")


def freeze(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder: cuts lineage (executor loss
    recomputes from here) and keeps later plans from re-expanding it."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def assign_blocks(df: DataFrame, key: Sequence[str], order: Sequence[str], n_blocks: int) -> DataFrame:
    """Add ``_blk``: consecutive ordered blocks of each key's history (frozen by checkpoint)."""
    ensure_checkpoint_dir(df.sparkSession)
    return (df.repartitionByRange(n_blocks, *key, *order)
              .withColumn("_blk", F.spark_partition_id())
              .checkpoint(eager=True))


def _on(key: Sequence[str], left: DataFrame, right: DataFrame, extra=()) -> Column:
    cond = None
    for k in key:
        c = left[k].eqNullSafe(right[f"_r_{k}"])
        cond = c if cond is None else cond & c
    for a, b in extra:
        cond = cond & (left[a] == right[b])
    return cond


def evaluate_blocked(frame: DataFrame, spec: Spec, order: Sequence[str] = ORDER) -> DataFrame:
    """All columns of ``spec`` for rows that carry ``_blk`` (see module doc)."""
    key = list(spec.key)
    lw = Window.partitionBy(*key, "_blk").orderBy(*order)
    incl = lw.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    # 1. summed values (whole numbers): running sums and non-null counts within the block
    values = {**{n: v for n, v in spec.sums_before.items()},
              **{n: v for n, (v, _) in spec.slides.items()}}
    src = {}
    for i, (n, v) in enumerate(values.items()):
        src[f"_sv{i}"] = F.coalesce(v.cast("long"), F.lit(0).cast("long"))
        src[f"_cv{i}"] = v.isNotNull().cast("long")
    local = frame.withColumns(src) if src else frame
    loc = {"_lr": F.row_number().over(lw).cast("long")}
    for i in range(len(values)):
        loc[f"_ls{i}"] = F.sum(f"_sv{i}").over(incl)
        loc[f"_lc{i}"] = F.sum(f"_cv{i}").over(incl)
    local = local.withColumns(loc)

    # 2. block totals -> offsets (one row per key and block)
    tot = local.groupBy(*key, "_blk").agg(
        F.count(F.lit(1)).alias("_tn"),
        *[F.sum(f"_sv{i}").alias(f"_ts{i}") for i in range(len(values))],
        *[F.sum(f"_cv{i}").alias(f"_tc{i}") for i in range(len(values))])
    ow = Window.partitionBy(*key).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    zero_l = F.lit(0).cast("long")
    offs = tot.select(
        *[F.col(k).alias(f"_r_{k}") for k in key], F.col("_blk").alias("_r_blk"),
        F.coalesce(F.sum("_tn").over(ow), zero_l).alias("_on"),
        *[F.sum(f"_ts{i}").over(ow).alias(f"_os{i}") for i in range(len(values))],
        *[F.coalesce(F.sum(f"_tc{i}").over(ow), zero_l).alias(f"_oc{i}") for i in range(len(values))])
    j = local.join(offs, _on(key, local, offs, [("_blk", "_r_blk")]), "left")
    pos = {"_pos": F.col("_on") + F.col("_lr")}
    for i in range(len(values)):
        inc = F.coalesce(F.col(f"_os{i}"), zero_l) + F.col(f"_ls{i}")
        pos[f"_pb{i}"] = inc - F.col(f"_sv{i}")       # prefix sum before the row
        pos[f"_cb{i}"] = F.col(f"_oc{i}") + F.col(f"_lc{i}") - F.col(f"_cv{i}")
    j = j.withColumns(pos).drop(*[c for c in offs.columns], "_lr",
                                *[f"_ls{i}" for i in range(len(values))],
                                *[f"_lc{i}" for i in range(len(values))])

    # 3. values at earlier positions: copy each row forward once per needed distance
    index = {n: i for i, n in enumerate(values)}
    wants: dict[int, dict[str, Column]] = {}
    for n, (c, d) in spec.lags.items():
        wants.setdefault(d, {})[f"_x_{n}"] = F.col(c)
    for n, (_, width) in spec.slides.items():
        i = index[n]
        wants.setdefault(width, {})[f"_x_pb{i}"] = F.col(f"_pb{i}")
        wants[width][f"_x_cb{i}"] = F.col(f"_cb{i}")
    out = j
    if wants:
        payload = sorted({p for d in wants.values() for p in d})
        ptypes = {}
        for d, cols in wants.items():
            for p, c in cols.items():
                ptypes[p] = j.select(c.alias("x")).schema["x"].dataType
        structs = [F.struct(F.lit(d).alias("_d"),
                            *[(cols[p] if p in cols else F.lit(None).cast(ptypes[p])).alias(p)
                              for p in payload])
                   for d, cols in sorted(wants.items())]
        moved = (j.select(*key, "_pos", F.explode(F.array(*structs)).alias("_s"))
                  .select(*[F.col(k).alias(f"_r_{k}") for k in key],
                          (F.col("_pos") + F.col("_s._d")).alias("_target"),
                          F.col("_s._d").alias("_d"), *[F.col(f"_s.{p}").alias(p) for p in payload]))
        picks = []
        for d, cols in sorted(wants.items()):
            for p in cols:
                picks.append(F.max(F.when(F.col("_d") == d, F.col(p))).alias(f"{p}__{d}"))
        shifted = moved.groupBy(*[f"_r_{k}" for k in key], "_target").agg(*picks)
        out = j.join(shifted, _on(key, j, shifted, [("_pos", "_target")]), "left")

    # 4. outputs
    res = {}
    pos_c = F.col("_pos")
    for n in spec.count_before:
        res[n] = F.when(pos_c > 1, pos_c - 1)
    for n in spec.count_incl:
        res[n] = pos_c
    for n, v in spec.sums_before.items():
        i = index[n]
        res[n] = F.when(F.col(f"_cb{i}") > 0, F.col(f"_pb{i}"))
    for n, width in spec.slide_counts.items():
        res[n] = F.when(pos_c > 1, F.least(pos_c - 1, F.lit(width).cast("long")))
    for n, (c, d) in spec.lags.items():
        res[n] = F.col(f"_x_{n}__{d}")
    for n, (_, width) in spec.slides.items():
        i = index[n]
        early = pos_c <= width
        s = F.when(early, F.col(f"_pb{i}")).otherwise(F.col(f"_pb{i}") - F.col(f"_x_pb{i}__{width}"))
        cnt = F.when(early, F.col(f"_cb{i}")).otherwise(F.col(f"_cb{i}") - F.col(f"_x_cb{i}__{width}"))
        res[n] = F.when(cnt > 0, s)
    out = out.withColumns(res)
    helpers = [c for c in out.columns if c.startswith(("_r_", "_x_", "_sv", "_cv", "_pb", "_cb"))
               or c in ("_pos", "_target")]
    return out.drop(*helpers)


def prefix_max_blocked(frame: DataFrame, key: Sequence[str], values: dict[str, Column],
                       order: Sequence[str]) -> DataFrame:
    """Running MAX up to and including the row, for rows with ``_blk`` (blocked)."""
    key = list(key)
    lw = Window.partitionBy(*key, "_blk").orderBy(*order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    local = frame.withColumns({f"_lm_{n}": F.max(v).over(lw) for n, v in values.items()})
    tot = local.groupBy(*key, "_blk").agg(*[F.max(v).alias(f"_tm_{n}") for n, v in values.items()])
    ow = Window.partitionBy(*key).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    offs = tot.select(*[F.col(k).alias(f"_r_{k}") for k in key], F.col("_blk").alias("_r_blk"),
                      *[F.max(f"_tm_{n}").over(ow).alias(f"_om_{n}") for n in values])
    j = local.join(offs, _on(key, local, offs, [("_blk", "_r_blk")]), "left")
    j = j.withColumns({n: F.greatest(F.col(f"_om_{n}"), F.col(f"_lm_{n}")) for n in values})
    return j.drop(*offs.columns, *[f"_lm_{n}" for n in values])
