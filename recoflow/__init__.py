"""recoflow: a Spark-native review and recommendation data engine.

Every stage is a DataFrame -> DataFrame function (or an MLlib estimator) so that
Catalyst sees the whole plan: casts, joins, filters and features are declared,
and pushdown, pruning and join strategy are left to the optimizer.
"""

__version__ = "0.1.0"
