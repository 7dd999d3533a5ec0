"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wattfolio.functions.numbers import one_digit


def decimal_comma(value: Column) -> Column:
    """One digit after a decimal comma: ``86,1``."""
    return F.replace(F.format_string("%.1f", one_digit(value)), F.lit("."), F.lit(","))


def filled(template: str, *values: Column) -> Column:
    return F.format_string(template, *values)


def template_of(series: Column, templates: dict[str, str]) -> Column:
    """The template configured for a series; NULL where there is none."""
    pairs = [F.lit(x) for item in templates.items() for x in item]
    return F.try_element_at(F.create_map(*pairs), series)
