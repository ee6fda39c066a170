"""Report sheets that arrive as a grid of cells: ``(sheet, row_no, c0, c1, ...)``, all text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.operators.fill import forward_fill


def drop_blank_rows(df: DataFrame, cells: list[str]) -> DataFrame:
    return df.dropna(how="all", subset=cells)


def promote_header(grid: DataFrame, names: list[str], header_row: int, row_no: str = "row_no") -> DataFrame:
    """Keep the rows under the header row and name the cells ``c0..cn`` after it."""
    cells = {f"c{i}": name for i, name in enumerate(names)}
    return grid.where(F.col(row_no) > header_row).withColumnsRenamed(cells)


def header_names(grid: DataFrame, header_row: int, row_no: str = "row_no") -> list[str]:
    """The one header row of a sheet, read to the driver because column names are schema, not data."""
    cells = [c for c in grid.columns if c.startswith("c") and c[1:].isdigit()]
    header = grid.where(F.col(row_no) == header_row).select(cells).first()
    if header is None:
        raise ValueError(f"the sheet has no row {header_row} to take column names from")
    return list(header)


def integral_text(column: str):
    """``1.0`` -> ``1``; other text is left alone."""
    return F.regexp_replace(column, r"^(-?\d+)\.0+$", "$1")


def repair_budget_grid(
    grid: DataFrame,
    names: list[str],
    header_row: int = 1,
    label: str = "office",
    sheet: str = "sheet",
    row_no: str = "row_no",
) -> DataFrame:
    """Title row off, header up, blank filler rows out, merged label cells filled down. The grain does not change."""
    rows = drop_blank_rows(promote_header(grid, names, header_row, row_no), names)
    filled = forward_fill(rows, label, group=[sheet], order=row_no)
    return filled.withColumn(label, integral_text(label))
