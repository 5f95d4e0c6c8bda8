"""Profiling, attribute ranking, outlier scoring and classification of tables on Spark."""
