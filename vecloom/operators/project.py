"""Choosing, renaming and dropping columns."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Selector = Callable[[DataFrame], DataFrame]

CHUNK_HELPERS = ("row_num", "chunk_id")

# Source column -> record column of the removal-event table.
REMOVAL_EVENT_COLUMNS = {
    ":ID(RemovalEvent)": "removal_id",
    "RMV_REA_TX": "removal_reason",
    "RMV_TRK_NO": "rmv_trk_no",
    "component_id": "component_id",
    "aircraft_id": "aircraft_id",
    "removal_date": "removal_date",
}


def quoted(name: str) -> Column:
    """A column by its literal name, whatever characters the name has."""
    return F.col("`" + name.replace("`", "``") + "`")


def map_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Keep exactly the mapped columns, under their new names."""
    return df.select(*[quoted(source).alias(target) for source, target in mapping.items()])


def select_columns(df: DataFrame) -> DataFrame:
    """The six record columns of the removal-event table."""
    return map_columns(df, REMOVAL_EVENT_COLUMNS)


def apply_selector(df: DataFrame, selector: Selector | Mapping[str, str] | None) -> DataFrame:
    """A caller's projection, as a function or a mapping; works on batch and stream alike."""
    if selector is None:
        return df
    if callable(selector):
        return df.transform(selector)
    return map_columns(df, selector)


def drop_helpers(df: DataFrame, helpers: Sequence[str] = CHUNK_HELPERS) -> DataFrame:
    return df.drop(*helpers)
