"""DataFrame operators: ingest, filters, roll-ups, windows, joins, summaries."""
