"""Column-name rules. They work on schema metadata, so plain Python is enough."""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import DataFrame

# Characters that part words in export headers, besides white space.
SEPARATORS = "-:\\/_"


def snake_case(name: str) -> str:
    """``OrderID`` / ``Order ID`` / ``order-id`` all become ``order_id``.

    A word ends at a separator, and before a capital that follows a small letter or digit; runs of capitals stay
    together, other marks are dropped. A leading or trailing underscore of the name is kept.
    """
    out, before = [], ""
    for char in name.strip():
        if char in SEPARATORS or char.isspace():
            if out[-1:] != ["_"]:
                out.append("_")
        elif char.isalnum():
            if "A" <= char <= "Z" and ("a" <= before <= "z" or "0" <= before <= "9"):
                out.append("_")
            out.append(char.lower())
        before = char
    return "".join(out)


def snake_case_columns(df: DataFrame) -> DataFrame:
    """Rename every column by :func:`snake_case`; two columns meeting in one name is an error."""
    sources = defaultdict(list)
    for column in df.columns:
        sources[snake_case(column)].append(column)
    clashes = {name: columns for name, columns in sources.items() if len(columns) > 1}
    if clashes:
        raise ValueError(f"columns collide after renaming: {clashes}")
    return df.toDF(*sources)


def digit_columns(df: DataFrame) -> list[str]:
    """Columns named by digits only, e.g. the year columns of a budget sheet."""
    return [column for column in df.columns if column.isdigit()]
