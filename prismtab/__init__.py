"""prismtab: Spark-native operators for large tabular classification workflows.

Every public function takes and returns ``pyspark.sql.DataFrame`` objects keyed
by an id column.  Work is expressed with built-in column expressions, joins,
aggregates and windows so that Catalyst can prune, push down and plan it.

Sub-packages
------------
sources    reading/writing tables, stand-in views over the test tables
functions  pure column expressions (features, probabilities, encoders)
operators  checks, joins, metrics, group-key scoring, folds, weights,
           threshold grids, arbitration, model selection, registry
plans      composed jobs: ``pyspark.ml`` out-of-fold model runs and the
           registered query catalogue used by ``__spark_entry__``
"""

__version__ = "0.1.0"
