"""larder: turn tables of stored web pages into clean recipe records with Spark.

Sub-packages

- ``functions``  Column expressions: text, dates, URLs, ingredients, DOM node arrays
- ``operators``  DataFrame operators: shredding, extraction, quality, report, upsert
- ``sources``    pages, feeds, sitemaps, stores and sinks
- ``plans``      whole jobs and the site rule data
- ``streaming``  the same ingest as Structured Streaming
"""
