"""Data contracts on Spark: clean, validate, profile, detect drift, compare runs."""
