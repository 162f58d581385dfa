"""Table -> table operators: columns, lookups, sets, match, links, ingest."""
