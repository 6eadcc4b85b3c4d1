"""Turn nested JSON records into one analysis-ready table, on Spark.

Every public function takes a session or DataFrames and returns DataFrames;
only sinks and the few documented size checks run jobs.
"""
