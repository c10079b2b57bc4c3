"""What to do with lines that cannot be parsed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FAILFAST = "failfast"
PERMISSIVE = "permissive"


def parsed_fields(*fields: Column) -> Column:
    """The parsed columns of a line, as the one row of a generator.

    A filter on a generated column stays above the generator. On a plain projection
    it would be pushed below, and every line would be parsed once for each filter
    and once more for the result.
    """
    return F.inline(F.array(F.struct(*fields)))


def keep_valid(parsed: DataFrame, valid: Column, line: Column, mode: str) -> DataFrame:
    """Drop malformed rows (permissive) or fail the job on the first one (failfast)."""
    valid = F.coalesce(valid, F.lit(False))
    if mode == PERMISSIVE:
        return parsed.filter(valid)
    if mode == FAILFAST:
        stop = F.raise_error(F.concat(F.lit("malformed line: "), line)).cast("boolean")
        return parsed.filter(F.when(valid, F.lit(True)).otherwise(stop))
    raise ValueError(f"unknown mode {mode!r}")
