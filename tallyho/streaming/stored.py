"""Reading the state that a stream has kept in its checkpoint (R10), as a batch
table: what a restarted query goes on from."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def state_variables(spark: SparkSession, checkpoint: str) -> dict[str, int]:
    """The variables that the stateful processors of a checkpoint keep, with the
    number of their operator."""
    found: dict[str, int] = {}
    # One row for each operator and store of the query.
    for row in spark.read.format("state-metadata").load(checkpoint).collect():
        properties = json.loads(row["operatorProperties"] or "{}")
        for variable in properties.get("stateVariables", []):
            found[json.loads(variable)["stateName"] if isinstance(variable, str) else variable["stateName"]] = row["operatorId"]
    return found


def stored_map(spark: SparkSession, checkpoint: str, variable: str) -> DataFrame:
    """(key, user_map_key, user_map_value) of a map variable, as of the newest
    committed batch."""
    return (
        spark.read.format("statestore")
        .option("path", checkpoint)
        .option("operatorId", state_variables(spark, checkpoint)[variable])
        .option("stateVarName", variable)
        .load()
        .select("key", "user_map_key", "user_map_value")
    )


def stored_counts(spark: SparkSession, checkpoint: str) -> DataFrame:
    """(name, n): the live names of :class:`tallyho.streaming.trailing.NameCounts`."""
    rows = stored_map(spark, checkpoint, "counts")
    return rows.select(F.col("user_map_key.name").alias("name"), F.col("user_map_value.n").alias("n"))
