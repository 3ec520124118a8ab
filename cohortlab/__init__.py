"""cohortlab: Spark-native cohort analytics.

Every operator takes and returns Spark DataFrames. Operators that learn
something split into a *fit* (one distributed aggregation whose result is
O(columns) in size) and a *transform* (plain column expressions, so the same
transform also runs on a streaming DataFrame).
"""

from cohortlab.session import get_session, scratch_dir

__all__ = ["get_session", "scratch_dir"]
