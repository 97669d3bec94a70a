"""Feature preparation, regression, search and explanation on pyspark.ml."""
