"""JSON reading and writing of lists and maps (J1-J4), as column functions.

Spark's JSON reader accepts single-quoted strings by default
(``allowSingleQuotes``), as the reference's mapper is configured to. Bad
JSON fails the job, as it does there; ``mode="PERMISSIVE"`` gives NULL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _opts(mode: str) -> dict:
    return {"mode": mode, "allowSingleQuotes": "true"}


def json_list_read(col: Column | str, element_type: str | None = "string",
                   mode: str = "FAILFAST") -> Column:
    """JSON text -> array. ``element_type=None`` keeps any shape as a
    ``variant`` (numbers keep their JSON type)."""
    schema = "variant" if element_type is None else f"array<{element_type}>"
    return F.from_json(F.col(col) if isinstance(col, str) else col, schema, _opts(mode))


def json_map_read(col: Column | str, key_type: str = "string", value_type: str = "string",
                  mode: str = "FAILFAST") -> Column:
    """JSON object text -> map."""
    return F.from_json(F.col(col) if isinstance(col, str) else col,
                       f"map<{key_type},{value_type}>", _opts(mode))


def json_map_write(col: Column | str) -> Column:
    """Map -> JSON text (NULL values kept, as a map serialiser does)."""
    return F.to_json(F.col(col) if isinstance(col, str) else col)


def json_list_write(col: Column | str) -> Column:
    """Array -> JSON text."""
    return F.to_json(F.col(col) if isinstance(col, str) else col)
