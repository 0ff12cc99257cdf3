"""Shared state of one feature job: inputs, skew policy, memoised aggregates."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from histwise.operators import item_stats, skew
from histwise.operators import windows as W
from histwise.plans import evaluate as E
from histwise.session import ensure_checkpoint_dir
from histwise.sources import tables
from histwise.sources.inputs import Inputs, bounded_broadcast, with_val_flag

BASE_COLUMNS = ("row_id", "user_id", "timestamp", "content_id", "answered_correctly",
                "prior_question_elapsed_time", "prior_question_had_explanation")

ITEM_COLUMNS = ("answers", "answered_users", "answers_per_user", "answers_after_second_time",
                "answered_users_after_second_time", "answers_rate_after_second_time",
                "answered_user_rate_after_second_time", "answers_per_user_after_second_time",
                "mean_content_accuracy", "weight")

PREVIOUS = ("content_id", "part", "answered_correctly", "val")


@dataclass
class FeatureContext:
    inputs: Inputs
    # None disables the hot-user path (every user takes plain windows).
    policy: skew.SkewPolicy | None = field(default_factory=skew.SkewPolicy)
    # Materialise small aggregates with checkpoint() so their size is known before
    # they are broadcast and their lineage is cut (survives executor loss).
    materialise: bool = True
    _memo: dict = field(default_factory=dict, repr=False)

    def _once(self, key, build):
        if key not in self._memo:
            self._memo[key] = build()
        return self._memo[key]

    def _fix(self, df: DataFrame) -> DataFrame:
        if not self.materialise:
            return df
        ensure_checkpoint_dir(df.sparkSession)
        return df.checkpoint(eager=True)

    def keys(self) -> tables.Keys:
        """Number and checksum of the question rows' ``row_id``, from one pass over that column of the log (S3)."""
        return self._once("keys", lambda: tables.keys_of(self.inputs.question_rows("row_id")))

    # -- the row frame ----------------------------------------------------------
    def base(self) -> DataFrame:
        """Question rows with ``part`` (broadcast join) and ``val`` (hold-out flag)."""
        def build():
            q = self.inputs.question_rows(*BASE_COLUMNS)
            qs = self.inputs.questions_side()
            q = q.join(qs, q.content_id == qs.question_id, "left").drop("question_id")
            return with_val_flag(q, self.inputs.val_side())
        return self._once("base", build)

    def marks(self) -> DataFrame:
        """Lecture marks per (user, timestamp) for the lecture flags."""
        return self._once("marks", lambda: E.lecture_marks(self.inputs.train_full()))

    def hot(self) -> skew.HotSplit | None:
        """Users whose history (questions + lecture marks) exceeds the policy threshold."""
        def build():
            if self.policy is None:
                return None
            users = self.base().select("user_id").unionByName(self.marks().select("user_id"))
            return skew.hot_keys(users, ("user_id",), self.policy)
        return self._once("hot", build)

    def windows(self, rows: DataFrame, specs, lectures: bool = False) -> DataFrame:
        # weights, alone or times an outcome of 0 or 1, have the bounds of the items' weights
        weighted = {n for s in specs for n in s.weighted}
        bounds = dict.fromkeys(weighted, self.weight_bounds()) if weighted else None
        return E.compute_windows(rows, specs, self.marks() if lectures else None, self.hot(), bounds)

    def weight_bounds(self) -> tuple[float | None, float | None]:
        """Smallest non-zero and largest weight of an item, from the small table of items."""
        return self._once("weight_bounds", lambda: W.value_bounds(self.items(), [F.col("weight")])[0])

    # -- item aggregates (one row per item) -------------------------------------
    def items(self) -> DataFrame:
        def build():
            tq = self.base().select("row_id", "user_id", "timestamp", "content_id",
                                    "answered_correctly", "val")
            return bounded_broadcast(self._fix(item_stats.item_summary(tq)))
        return self._once("items", build)

    def with_items(self, df: DataFrame) -> DataFrame:
        if "_i_weight" in df.columns:
            return df
        it = self.items().select("content_id", *[F.col(c).alias(f"_i_{c}") for c in ITEM_COLUMNS])
        return df.join(it, "content_id", "left")

    # -- conditional (posterior) aggregate --------------------------------------
    def posterior(self, min_support: int) -> DataFrame:
        def build():
            tq = self.base().select("row_id", "user_id", "timestamp", "content_id",
                                    "answered_correctly", "part", "val")
            lagged = self.windows(tq, [previous_spec(PREVIOUS)])
            agg = item_stats.conditional_mean(lagged, min_support)
            return bounded_broadcast(self._fix(agg))
        return self._once(("posterior", min_support), build)


def previous_spec(cols) -> W.Spec:
    """``prev_<c>`` = the previous row's ``c`` in the user's history."""
    return W.Spec(("user_id",), lags={f"prev_{c}": (c, 1) for c in cols})
