"""plantwise: Spark-native cost, energy and manufacturing analytics.

Every operator is a function from DataFrame(s) to DataFrame written with
built-in Spark expressions, so Catalyst and adaptive execution plan the work.
"""

__version__ = "0.1.0"
