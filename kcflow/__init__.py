"""kcflow: step-log analytics and first-attempt prediction on Spark.

Subpackages: ``sources`` (tables, fixture views, TSV, feature store),
``functions`` (column expressions), ``operators`` (rates, codes, running
numbers, exploration, step construction), ``plans`` (feature table, models,
scoring, registered queries) and ``streaming`` (incremental step roll-up).
"""
