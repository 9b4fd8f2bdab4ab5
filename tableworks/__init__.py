"""Data operators and named jobs for open-source Spark.

Every operator is a plain ``DataFrame -> DataFrame`` function; nothing reads
the clock, and nothing is collected unless its size is bounded and said so.
"""
