"""cinelens: film-catalog analytics as plain Spark DataFrame operators.

Layout
------
- ``functions``  Column -> Column helpers (dates, list-literal parsing, money).
- ``operators``  DataFrame -> DataFrame building blocks (filters, dedup,
  ranking, aggregates).
- ``sources``    readers (CSV with declared schema, parquet tables), the
  driver-table adapter that exposes film-shaped views, and writers (CSV,
  keyed and optionally bucketed tables).
- ``plans``      the business questions (cleaning, ratings, genres, companies,
  profit, trends, directors, reports; SQL-text forms in ``plans.sql``).
- ``jobs``       command line: ingest files into keyed tables, one job per question.
- ``queries``    the registered queries over the driver tables.
"""

__version__ = "0.1.0"
