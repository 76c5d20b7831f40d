"""Names for columns that an operator adds to a table of its caller's."""

from __future__ import annotations

from pyspark.sql import DataFrame


def free_prefix(df: DataFrame) -> str:
    """So many underscores that no column of ``df`` begins with them: one, unless such columns are there.

    Operators name all their columns by it, so they neither replace nor read a caller's column.
    """
    p = "_"
    while any(c.startswith(p) for c in df.columns):
        p += "_"
    return p
