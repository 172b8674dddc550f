"""SQL functions by name (U1-U5), as SQL temporary functions.

The source registered row-at-a-time Python UDFs and called them by name.
Here the same names are SQL functions whose bodies are native
expressions, so ``SELECT mask_last4(number)`` or
``F.call_function('mask_last4', col)`` runs in codegen with no Python
worker.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

SQL_FUNCTIONS = {
    "hide_account_number":
        "(s STRING) RETURNS STRING RETURN concat('****', right(s, 4))",
    "hide_phone_number":
        "(s STRING) RETURNS STRING RETURN concat('****', right(s, 3))",
    "add_number":
        "(s STRING) RETURNS STRING RETURN concat('****', CAST(CAST(conv(substring(md5(s), 1, 8), 16, 10) AS BIGINT) % 9000 + 1000 AS STRING))",
    "date_to_int":
        "(d DATE) RETURNS INT RETURN CAST(date_format(d, 'yyyyMMdd') AS INT)",
}


def register_sql_functions(spark: SparkSession) -> list[str]:
    for name, body in SQL_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}{body}")
    return list(SQL_FUNCTIONS)
