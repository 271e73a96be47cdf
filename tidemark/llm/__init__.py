"""Training-data operators on Spark DataFrames.

Nothing outside this subpackage imports it; ``queries`` registers its
queries, and ``__spark_entry__`` adds them when the subpackage is present.
"""
