"""Sluicegate: delimited files of unknown shape into typed, checked tables, as Spark jobs.

Every public function takes a DataFrame (or a SparkSession and a path) plus plain
arguments and returns a DataFrame. There is no settings object and no global state.
"""
