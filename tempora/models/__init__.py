"""Forecasters on ``pyspark.ml``."""
