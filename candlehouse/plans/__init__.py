"""Jobs that write tables: ingest, load, mart refresh, rollup refresh, news."""
