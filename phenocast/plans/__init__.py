"""Stand-in views, registered queries with SQL oracles, end-to-end pipelines."""
