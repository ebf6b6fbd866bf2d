"""vireo — reusable analytics operators on PySpark DataFrames, Spark SQL and
Structured Streaming.

Every operator is a function ``DataFrame -> DataFrame`` (or a small builder
around a reader/writer) that stays lazy: nothing is collected to the driver,
and the physical strategy is left to Catalyst and AQE.
"""

from vireo.session import build_session, checkpoint_dir  # noqa: F401

__all__ = ["build_session", "checkpoint_dir"]
