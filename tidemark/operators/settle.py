"""Intermediate tables for rows that several passes read."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidemark import workspace
from tidemark.operators.sizing import ONE_TASK_BYTES, input_bytes


def is_stored(df: DataFrame) -> bool:
    """Whether rows are read from files as they are, at most with columns chosen: reading them again costs a scan."""
    plan = df._jdf.queryExecution().optimizedPlan()
    while plan.nodeName() == "Project":
        plan = plan.child()
    return plan.nodeName() == "LogicalRelation" or plan.nodeName().startswith("Relation")


def settle(df: DataFrame, label: str, above: int = ONE_TASK_BYTES) -> DataFrame:
    """Write rows once to the shared folder if their input is large, and read them back.

    Key sizes, cut points and carried values are separate passes. On the written table each
    pass reads only its columns, nothing upstream (JSON parsing, joins) runs again, and lost
    executors cost no more than the tasks they ran.
    """
    if input_bytes(df) <= above:
        return df
    path = workspace.fresh_folder(df.sparkSession, label)
    df.write.parquet(path)
    workspace.note_folder(path)
    if input_bytes(df) > ONE_TASK_BYTES:
        workspace.release_shuffles(df.sparkSession)
    return df.sparkSession.read.schema(df.schema).parquet(path)
