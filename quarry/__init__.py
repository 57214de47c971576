"""quarry: Spark-native jobs for edge-list ranking, delimited-table sorting and the
data side of data-parallel classifier training and evaluation.

Every operator takes and returns a :class:`pyspark.sql.DataFrame`; plans are left to
Catalyst. The only Python code that runs inside tasks is the per-batch gradient
function in :mod:`quarry.operators.training`.
"""

__all__ = ["session", "functions", "operators", "sources", "sinks", "plans"]
