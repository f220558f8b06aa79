"""Track-catalogue analytics on Spark: clean, check, aggregate, report, score."""
