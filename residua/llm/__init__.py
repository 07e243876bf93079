"""Operators of a training-data pipeline over documents, pages and vectors.

Nothing outside this package imports it. Each module holds one operator; ``queries``
registers them. Texts are worked on in Arrow batches inside the tasks, Spark partitions,
shuffles and joins the work.
"""
