"""Spark-native data reliability for energy forward curves.

Every operator is a plain ``DataFrame -> DataFrame`` function with explicit
clock arguments, so one definition serves batch jobs, micro-batches and tests.
"""
