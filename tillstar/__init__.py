"""tillstar: retail analytics as Spark DataFrame jobs.

Order lines become a checked star schema; named measures, time intelligence,
rankings, row-level security, customer analytics and report datasets are
computed on it with the DataFrame API.
"""

from tillstar.star import Star

__all__ = ["Star"]
