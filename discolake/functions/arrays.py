"""Expressions over arrays of structs and arrays of scalars.

``array[field]`` takes a field out of every struct at once.  Unlike the
lambda functions ``transform`` and ``filter`` it compiles with its stage.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ids_to_csv(array: Column, field: str = "id") -> Column:
    """``[{id: a}, {id: b}]`` to ``"a,b"``; empty to ``''``, null to null.

    Null ids are skipped.  ``concat_ws`` would turn a null array into ``''``.
    """
    return F.array_join(array[field], ",")


def values_to_csv(array: Column) -> Column:
    """Scalars to one comma string; null elements print as ``None``."""
    return F.array_join(array, ",", "None")


def first_where(array: Column, field: str, value: str, out: str) -> Column:
    """``out`` of the first element whose ``field`` is ``value``, else null.

    A match whose ``out`` is null ends the search with null.
    """
    position = F.array_position(array[field], value)  # from 1; 0 is none
    return F.get(array[out], (position - 1).cast("int"))


def first_field(array: Column, field: str) -> Column:
    """``field`` of the first element; null for an empty or null array."""
    return F.get(array, F.lit(0))[field]
