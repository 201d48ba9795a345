"""Text normalisation (PRJ-1, PRJ-2)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from otif.model import UPPERCASE_FIELDS


def normalise(col: Column | str) -> Column:
    """Trim outer spaces; blank becomes null."""
    col = F.col(col) if isinstance(col, str) else col
    return F.nullif(F.trim(col), F.lit(""))


def normalise_code(name: str) -> Column:
    """Normalise a source field; code fields are also upper-cased."""
    value = normalise(name)
    return F.upper(value) if name in UPPERCASE_FIELDS else value
