"""stagewise — process, data-quality and portfolio analytics as Spark DataFrame operators.

Every public function takes DataFrames and column names and returns a
DataFrame.  A few run a bounded job while the query is built (one row of
bounds, counts or a threshold), as their docstrings say.  Sub-packages:

* ``sources``   – schemas, readers, sinks, catalog helpers, test-data adapters
* ``functions`` – column expressions (rounding, intervals, lenient parsing)
* ``operators`` – composite operators (quality reports, cleaning, process
  analytics, portfolio model, cards, reconciliation, chart frames)
* ``plans``     – view registration and the query registry used by the driver
* ``streaming`` – the same quality counters over a streaming source
"""

from stagewise.session import get_spark, checkpoint_dir, materialize

__all__ = ["get_spark", "checkpoint_dir", "materialize"]
