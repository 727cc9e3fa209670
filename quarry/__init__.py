"""quarry: Spark-native incident analytics.

Column-parametric DataFrame -> DataFrame operators for wide incident
tables (scans, address parsing, imputation, anomaly rules, grouped /
joined / windowed business queries, profiling, imbalance analysis,
deterministic re-sampling, correlation / PCA / FAMD), built from Spark
SQL built-ins and ``pyspark.ml`` so that all heavy work runs on the
executors.
"""

__version__ = "0.1.0"
