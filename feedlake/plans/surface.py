"""The layers in SQL: views of silver and gold, and table functions of a day.

    SELECT * FROM miss_distances(DATE'2025-06-01') ORDER BY miss_distance_ld

A function's day becomes a constant of the plan, so that only its partition is read.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from feedlake.sources import tables
from feedlake.sources.schemas import SILVER_COLUMNS

DAY = "observation_date"
# of each function: the view it reads and the columns it gives
FUNCTIONS = {
    "approaches": ("silver", SILVER_COLUMNS),
    "miss_distances": ("gold", ["name", "miss_distance_ld"]),
    "velocities": ("gold", ["name", "velocity_kps"]),
}


def register(spark: SparkSession, silver: str, gold: str) -> None:
    """Views `silver` and `gold` of two tables, by name or path, and FUNCTIONS, for this session.

    Registering again replaces them, as is needed when a path has gained its first partition.
    """
    columns = {}
    for view, table in (("silver", silver), ("gold", gold)):
        rows = tables.read_table(spark, table)
        rows.createOrReplaceTempView(view)
        columns[view] = rows
    for name, (view, wanted) in FUNCTIONS.items():
        rows = columns[view]
        kinds = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in wanted)
        grain = tables.grain_of(rows.columns, DAY)
        pruned = "" if grain == tables.DAY else f" AND {tables.partition_column(DAY, grain)} = trunc({name}.day, '{grain}')"
        spark.sql(
            f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(day DATE) RETURNS TABLE ({kinds}) "
            f"RETURN SELECT {', '.join(wanted)} FROM {view} WHERE {DAY} = {name}.day{pruned}"
        )
