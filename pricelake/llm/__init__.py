"""Training-data operators: each module builds one operator as a Spark job.

Nothing else in the package imports this subpackage; ``registry`` lists its
queries and their SQL for the entry point.
"""
