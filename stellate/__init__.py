"""stellate — a Spark-native star-schema loader for arrival records.

Reusable DataFrame operators (sources, scalar functions, de-duplication,
lookup joins, surrogate keys, profiles, quality checks, sinks) composed into
table builders and one end-to-end load.  Everything is expressed with the
DataFrame API so Catalyst plans it and the cluster does the work.
"""

__version__ = "0.1.0"
