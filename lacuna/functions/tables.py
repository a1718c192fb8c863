"""Table functions for SQL, each a SQL body that Spark plans with the query around it."""

from __future__ import annotations

from pyspark.sql import SparkSession

FUNCTIONS = {
    "expand_ranges": ("spec STRING", "value BIGINT", """
        SELECT explode(array_sort(array_distinct(flatten(transform(split(replace(spec, '_to_', ':'), '_'), token -> sequence(
            cast(element_at(split(token, ':'), 1) AS BIGINT), cast(element_at(split(token, ':'), -1) AS BIGINT)))))))"""),
    "key_values": ("line STRING", "key STRING, value STRING", """
        SELECT explode(str_to_map(line, '[,;]', '='))"""),
}


def register(spark: SparkSession) -> None:
    """Make the functions known to the session, for use after FROM and LATERAL."""
    for name, (given, result, body) in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({given}) RETURNS TABLE ({result}) RETURN {body}")
