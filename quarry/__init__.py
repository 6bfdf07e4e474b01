"""quarry: data-analysis operators written as Spark DataFrame -> DataFrame functions.

Sub-packages
------------
sources    readers for delimited text and stage tables, sinks
functions  Column-level helpers (renames, strings, dates, maths) and
           scalar distribution functions used on one-row results
operators  relational, feature, sampling, statistics, chart, model and
streaming  stateless operators attached to a streaming source
catalog    registered queries and their DuckDB twins
"""

from quarry.session import get_session, table, checkpoint_dir

__all__ = ["get_session", "table", "checkpoint_dir"]
