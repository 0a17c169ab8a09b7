"""Cell texts such as ``1,234 P``: a number, then optionally a status."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from statloom.fixed_values import DEFAULT_STATUS, MISSING_CELL, SUPPRESSED_STATUSES

# try_cast alone would also take `1d`, `Inf` and `NaN`.
_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def cell_value(text: Column) -> Column:
    """Number in front of the first space, commas taken out; NULL if it is not one."""
    token = F.replace(F.substring_index(F.trim(text), " ", 1), F.lit(","), F.lit(""))
    # Missing cells are many and need no pattern.
    return F.when(text == MISSING_CELL, None).when(token.rlike(_NUMBER), token.try_cast("double"))


def cell_status(text: Column) -> Column:
    """Second word of the cell, ``F`` when there is none."""
    cell = F.trim(text)
    behind = F.substring(cell, F.instr(cell, " ") + 1, F.length(cell))
    return F.when(F.instr(cell, " ") > 0, F.substring_index(behind, " ", 1)).otherwise(DEFAULT_STATUS)


def cell_value_text(text: Column) -> Column:
    """Text in front of the first space, NULL for a missing cell."""
    return F.when(text != MISSING_CELL, F.get(F.split(text, " ", 2), F.lit(0)))


def cell_status_rest(text: Column) -> Column:
    """Everything behind the first space, NULL when there is none."""
    return F.get(F.split(text, " ", 2), F.lit(1))


def is_published(value: Column, status: Column) -> Column:
    """Keeps numbers, and missing values whose status says that they were withheld."""
    return value.isNotNull() | status.isin(*SUPPRESSED_STATUSES)
