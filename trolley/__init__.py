"""Shopper-behaviour analytics as plain PySpark DataFrame and Spark ML jobs."""
