"""Compositions of operators: landing, star schema, customer 360, and the
query catalogue over the driver's tables (``catalog/``, registered in
``bank_queries.QUERIES``, with DuckDB equivalents in ``oracle``)."""
