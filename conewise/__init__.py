"""conewise: retail analytics for a counter-and-delivery shop, written on PySpark.

Every model is a plain function ``DataFrame(s) -> DataFrame`` built from
``pyspark.sql.functions`` so Catalyst, AQE and whole-stage codegen do the
planning.  Layout:

- ``sources``    scans, seeds, exports, materialisation, test-table bindings
- ``functions``  one-line column builders (flags, ladders, bands, calendar)
- ``operators``  distributed rank, skew-safe per-key windows, multi-step aggregates
- ``plans``      the composite jobs (identity, cost, facts, customers, finance,
                 rankings), the ``Shop`` model graph and report-side jobs
- ``quality``    key checks, frame profile, cost coverage
- ``oracle``     DuckDB SQL the jobs are checked against
- ``streaming``  nothing: the source system has no streaming work (see README)
"""

from conewise.session import get_spark, checkpoint_dir  # noqa: F401

__all__ = ["get_spark", "checkpoint_dir"]
