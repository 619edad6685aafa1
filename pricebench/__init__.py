"""Text-to-price data work on Spark: parse, curate, featurise, fit, evaluate."""
