"""churnlake: Spark-native customer-churn analytics.

Every operator is a DataFrame -> DataFrame function built from Spark SQL
expressions, so Catalyst plans it and the work runs on the executors.
"""

__version__ = "0.1.0"
