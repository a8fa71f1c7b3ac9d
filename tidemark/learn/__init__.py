"""Model training, checking, scoring and explaining on ``pyspark.ml``."""
