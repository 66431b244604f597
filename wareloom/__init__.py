"""wareloom: a staged-warehouse engine on PySpark.

Sources are read as partitioned DataFrames, repaired with column
expressions, checked against schema/null contracts, loaded by
overwrite / append / replace-by-key, enriched with locations and regions,
and exported.  All data work is DataFrame / SQL code planned by Catalyst.
"""

from wareloom.session import build_session, scratch_path

__all__ = ["build_session", "scratch_path"]
