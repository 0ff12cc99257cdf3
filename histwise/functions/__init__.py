"""Column-expression helpers (JVM-side, inside whole-stage codegen)."""

from histwise.functions.exprs import (
    change_rate, flag, odds_weight, ratio, seq2vec,
)
from histwise.functions.vectors import cosine, dot, l2_norm

__all__ = ["change_rate", "flag", "odds_weight", "ratio", "seq2vec",
           "cosine", "dot", "l2_norm"]
