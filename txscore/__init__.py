"""Card payment scoring on Spark: history load, model training and a scoring stream."""
