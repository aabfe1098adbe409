"""paddock: a Spark-native medallion analytics engine for season-based competition data.

Layers (all lazy DataFrame jobs):

- ``sources``   typed readers for landed files and the driver test-table bindings
- ``functions`` column expressions (race key, surrogate key, label ladder, lap format, numeric rules)
- ``operators`` reusable relational operators (NOT IN anti join, incremental append, upsert,
                SCD2, skew-safe running sum, top-k, lookups, expectations)
- ``plans``     staging models, marts, dashboard analytics, guarded ad-hoc SQL, ``build_all``
- ``sinks``     versioned tables, season replace, CSV export
- ``streaming`` incremental staging as an ``availableNow`` stream
"""

__all__ = ["__version__"]
__version__ = "0.1.0"
