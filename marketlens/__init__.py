"""marketlens: search-marketing analytics as lazy Spark DataFrame operators.

Every operator is ``fn(df, ...) -> DataFrame`` built from native Spark SQL
expressions; nothing collects to the driver.  Sub-packages:

* ``functions``  column expressions (number parsing, lexicons, cell typing)
* ``sources``    table readers, fixture views, client settings, sinks
* ``operators``  reviews, keywords, paid media, projections, AI visibility,
                 links/backlinks, traffic, row typing, dashboard reshaping
* ``plans``      the registry of named queries and their DuckDB oracles
* ``streaming``  the review scorer under Structured Streaming
"""

__version__ = "0.1.0"
