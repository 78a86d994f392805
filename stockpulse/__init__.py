"""stockpulse — retail demand analytics on Spark.

Every operator is a lazy ``DataFrame -> DataFrame`` (or ``DataFrame ->
small-report DataFrame``) function built from native Spark SQL
expressions, windows, grouping sets and Spark ML.  Sub-packages:

* ``sources``    – table readers/writers and the test-data panel builder
* ``functions``  – reusable column expressions (hierarchy ids, guards, PAV)
* ``operators``  – the stage operators (panel, features, quality, metrics,
                   conformal, calibration, risk, impact, serving, forecast)
* ``plans``      – end-to-end stage compositions and the query registry
"""

from stockpulse.config import EngineConfig  # noqa: F401

__all__ = ["EngineConfig"]
__version__ = "0.1.0"
