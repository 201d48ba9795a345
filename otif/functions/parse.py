"""Grammar-gated parsers for dates and locale numbers (PRJ-3, PRJ-4).

Both return null for text outside the grammar or for impossible values, so a
rule can flag ``text IS NOT NULL AND parsed IS NULL``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from otif.model import DATE_FORMATS, NUMBER_PATTERN, QUANTITY_TYPE


def parse_date(col: Column | str) -> Column:
    col = F.col(col) if isinstance(col, str) else col
    return F.coalesce(*[
        F.when(col.rlike(pattern), F.try_to_timestamp(col, F.lit(fmt)).cast("date"))
        for pattern, fmt in DATE_FORMATS
    ])


def parse_number(col: Column | str, to_type: str = QUANTITY_TYPE) -> Column:
    """Decimal dot or comma; overflow and over-long fractions give null."""
    col = F.col(col) if isinstance(col, str) else col
    return F.when(col.rlike(NUMBER_PATTERN),
                  F.replace(col, F.lit(","), F.lit(".")).try_cast(to_type))
