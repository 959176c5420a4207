"""Jobs that read tables, run operators and write tables; and the registered queries."""
