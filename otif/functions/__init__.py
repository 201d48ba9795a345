"""Column-level helpers: every function returns a ``pyspark.sql.Column``."""

from otif.functions.parse import parse_date, parse_number
from otif.functions.reasons import append_reasons, empty_reasons, reasons
from otif.functions.text import normalise, normalise_code

__all__ = ["parse_date", "parse_number", "reasons", "append_reasons", "empty_reasons",
           "normalise", "normalise_code"]
