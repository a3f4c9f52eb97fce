"""Monthly customer feature books, lagged joins, tree models and causal estimates on Spark."""
