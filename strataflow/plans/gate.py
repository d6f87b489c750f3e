"""Validate a bronze dataset, then promote its complete rows."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.operators.calendar import add_ingestion_columns, add_transform_columns
from strataflow.operators.quality import validate_bronze


def bronze_to_silver_gate(
    df: DataFrame, dataset: str, required: Sequence[str], as_of: dt.date, date_column: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Rows with all required columns, stamped for silver; and the check results of the whole input."""
    bronze = add_ingestion_columns(df, as_of, date_column)
    results = validate_bronze(bronze, dataset)
    complete = reduce(lambda a, b: a & b, [F.col(n).isNotNull() for n in required], F.lit(True))
    return add_transform_columns(bronze.where(complete), as_of, date_column), results
