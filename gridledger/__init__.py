"""gridledger: PySpark-native landing, validation, keyed upsert and forecast-accuracy for interval data.

Subpackages: ``functions`` (column helpers), ``sources`` (file readers), ``operators`` (generic
DataFrame operators), ``plans`` (dataset configs, ingest, sweep, exports, registered queries) and
``streaming`` (catch-up file streams). ``session.build_session`` creates a correctly configured session.
"""

__version__ = "0.1.0"
