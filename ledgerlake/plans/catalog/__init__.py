"""The query catalogue over the driver's tables, by theme; registered in
``plans.bank_queries.QUERIES``."""
