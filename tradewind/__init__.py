"""Reusable Spark operators for retail and e-commerce analytics.

Every public function takes DataFrames and returns a DataFrame; nothing here
uses a Python UDF or an RDD.

* ``functions``  column expressions (money, dates, labels, text cleaning)
* ``operators``  relational, quality, ordering, basket and SCD operators
* ``sources``    CSV, parquet and table readers and writers
* ``plans``      the business questions built from the operators
* ``streaming``  incremental customer batches as a stream
* ``catalog``    the operators bound to the driver tables, each with its SQL
"""
