"""Fixed column order of reports and electronic records."""

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def feed_layout(frame: DataFrame, fields: Mapping[str, Column | str]) -> DataFrame:
    """Selects ``fields`` in order: a column expression, or a text constant such as a zero filler."""
    return frame.select(
        [(F.lit(v) if isinstance(v, str) else v).alias(name) for name, v in fields.items()]
    )


def present(frame: DataFrame, titles: Mapping[str, str]) -> DataFrame:
    """Renames and orders columns for reading; columns without a title are dropped."""
    return frame.select([F.col(f"`{c}`").alias(title) for c, title in titles.items()])


def with_text_null(frame: DataFrame, name: str) -> DataFrame:
    """Adds an empty text column, to be filled later."""
    return frame.withColumn(name, F.lit(None).cast("string"))
