"""Spark-native logistics network analytics.

Every public function takes DataFrames and returns a lazy DataFrame.  The layers are

* ``sources``    raw all-string extracts in, published tables out
* ``functions``  Column expressions: casts, flags, geometry, rounding
* ``operators``  reusable DataFrame transforms: keep-first, lookups, percentiles
* ``plans``      the quality-scored tables, the facts, audits and measures
* ``streaming``  the append-only refresh of the transactional feeds
"""
