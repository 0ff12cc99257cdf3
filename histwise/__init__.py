"""histwise: leak-aware history features and model evaluation on Spark.

An interaction log ("user met item at time t, with an outcome") goes in;
per-row features keyed by ``row_id``, a training matrix, a gradient-boosted
model, exact AUC and a drift check come out. Everything is expressed with
DataFrames, window specifications and MLlib, so Catalyst plans it.
"""

__version__ = "0.1.0"
