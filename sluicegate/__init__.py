"""Quality-gated lakehouse tables as Spark DataFrames.

Every operator is a ``DataFrame -> DataFrame`` function built from Spark SQL
expressions.  Small specifications (fields, rules, orderings, averages) say what a
table should look like; Catalyst decides how to run it.
"""

from sluicegate.run import Run
from sluicegate.session import build_session, shared_scratch, shuffle_partitions_for

__all__ = ["Run", "build_session", "shared_scratch", "shuffle_partitions_for"]
