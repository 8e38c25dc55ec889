"""Function packs of model formulas as column expressions: format, key figures, conversion and markup.

Null arguments give null, but for texts that are joined only from parts that are there.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

#: fixed values: colours and signs of the key-figure pack, for the bands from 1, from 0.8 and below
STATUS_COLORS = ("%2322C55E", "%23F59E0B", "%23EF4444")
STATUS_ICONS = ("✅", "⚠", "❌")
TREND_SIGNS = ("▲ ", "▼ ", "▬ ")


def _rounded(v: Column, digits: int) -> Column:
    """The whole number next to v times a power of ten, divided by it: what that product is as a double decides halves, not the digits that v is shown with."""
    v = v.cast("double")
    return F.round(v * 10.0**digits, 0) / 10.0**digits if digits else F.round(v, 0)


def _decimals(v: Column, digits: int) -> Column:
    return F.format_string(f"%.{digits}f", _rounded(v, digits))


def format_number(v: Column, digits: int) -> Column:
    """Digits after the point; before it at least as many, and one at least."""
    width = max(1, digits) + digits + (digits > 0)
    return F.format_string(f"%0{width}.{digits}f", _rounded(F.abs(v.cast("double")), digits)) if digits else _decimals(F.abs(v), 0)


def format_percent(v: Column, digits: int) -> Column:
    return F.concat(_decimals(v * 100, digits), F.lit("%"))


def format_currency(v: Column, symbol: str) -> Column:
    return F.concat(F.lit(symbol), F.format_number(_rounded(v, 2), 2))


def pad_left(v: Column, length: int, ch: str) -> Column:
    return F.right(F.concat(F.repeat(F.lit(ch), length), v.cast("string")), F.lit(length))


def pad_right(v: Column, length: int, ch: str) -> Column:
    return F.left(F.concat(v.cast("string"), F.repeat(F.lit(ch), length)), F.lit(length))


def _ratio(v: Column, target: Column) -> Column:
    return F.when(target != 0, v / target).otherwise(0.0)


def _band(v: Column, target: Column, marks: tuple[str, ...]) -> Column:
    r = _ratio(v, target)
    return F.when(r >= 1, marks[0]).when(r >= 0.8, marks[1]).otherwise(marks[2])


def status_color(v: Column, target: Column) -> Column:
    return _band(v, target, STATUS_COLORS)


def status_icon(v: Column, target: Column) -> Column:
    return _band(v, target, STATUS_ICONS)


def trend_arrow(now: Column, before: Column) -> Column:
    return F.when(now > before, TREND_SIGNS[0]).when(now < before, TREND_SIGNS[1]).otherwise(TREND_SIGNS[2])


def variance_format(v: Column, target: Column) -> Column:
    return F.concat(F.when(v >= target, "+").otherwise(""), format_percent(_ratio(v - target, target), 1))


def html_bold(v: Column) -> Column:
    return F.concat(F.lit("<b>"), v, F.lit("</b>"))


def html_italic(v: Column) -> Column:
    return F.concat(F.lit("<i>"), v, F.lit("</i>"))


def html_color(v: Column, color: str) -> Column:
    return F.concat(F.lit(f"<span style='color:{color}'>"), v, F.lit("</span>"))


def html_size(v: Column, size: int) -> Column:
    return F.concat(F.lit(f"<span style='font-size:{size}px'>"), v, F.lit("</span>"))


def color_hex_to_rgb(v: Column) -> Column:
    part = lambda at: F.conv(F.substring(v, at, 2), 16, 10)
    return F.concat(F.lit("rgb("), part(2), F.lit(","), part(4), F.lit(","), part(6), F.lit(")"))


#: fixed values: types that a function's parameters may name
TYPES = {"DOUBLE": "double", "STRING": "string", "BOOLEAN": "boolean", "INT64": "bigint", "DECIMAL": "decimal(18,4)", "DATETIME": "timestamp"}


def applied(params: str, body: str, args: dict[str, str]) -> Column:
    """A function given as text, applied to columns: each parameter (`name: TYPE`, divided by commas) stands for its column, cast to its type.

    args: parameter -> column name. Names inside quotes stay text. A parameter without a column, or of a type that isn't known, is an error.
    """
    bound = {}
    for p in filter(None, map(str.strip, params.split(","))):
        name, _, kind = (x.strip() for x in p.partition(":"))
        if name not in args or kind not in TYPES:
            raise ValueError(f"parameter {p!r} has no column or no known type")
        bound[name] = f"cast(`{args[name]}` as {TYPES[kind]})"
    return F.expr(re.sub(r"'(?:[^']|'')*'|[A-Za-z_]\w*", lambda m: bound.get(m.group(), m.group()), body))
