"""Acquisitions and invoice analytics on Spark.

Sub-packages:

* ``functions`` – pure ``Column -> Column`` helpers (money, codes, text keys).
* ``operators`` – ``DataFrame -> DataFrame`` building blocks (allocation with
  residual, nesting/unnesting, first-by look-ups, reshaping).
* ``sources``   – reading source relations (parquet / CSV / JDBC), deriving them
  from the test tables, and the table sinks.
* ``plans``     – the marts, report views and parameterised report queries.
"""

__version__ = "0.1.0"
