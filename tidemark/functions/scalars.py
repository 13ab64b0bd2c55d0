"""Tolerant coercion, strings, arguments, dates and small matrices."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_number(text: Column) -> Column:
    """Text to a finite double; "a/b" is a fraction; anything else is null."""
    t = F.trim(text)
    plain = t.try_cast("double")
    top, bottom = F.split_part(t, F.lit("/"), F.lit(1)).try_cast("double"), F.split_part(t, F.lit("/"), F.lit(2)).try_cast("double")
    value = F.when(t.contains("/"), F.try_divide(top, bottom)).otherwise(plain)
    return F.when(~F.isnan(value) & (F.abs(value) != float("inf")), value)


def finite(value: Column) -> Column:
    return value.isNotNull() & ~F.isnan(value) & (F.abs(value) != float("inf"))


def rounded(value: Column, digits: int) -> Column:
    """Half to even; null where it isn't finite."""
    return F.when(finite(value), F.bround(value, digits))


def rotation_degrees(value: Column) -> Column:
    return F.pmod(F.round(value).cast("long"), F.lit(360))


def list_of(text: Column) -> Column:
    """Comma list: trimmed, without empties."""
    return F.filter(F.transform(F.split(text, ","), lambda x: F.trim(x)), lambda x: x != "")


def option(argv: Column, name: str) -> Column:
    """The value of --name in an array of arguments, written "--name value" or "--name=value"."""
    at = F.array_position(argv, name).cast("int")
    joined = F.get(F.filter(argv, lambda a: a.startswith(f"{name}=")), F.lit(0))
    return F.coalesce(F.when(at > 0, F.get(argv, at)), F.substring(joined, F.lit(len(name) + 2), F.length(joined)))


def xml_escape(text: Column) -> Column:
    out = text
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


def human_duration(seconds: Column) -> Column:
    s = seconds.cast("long")
    return F.format_string("%dh %02dm %02ds", F.expr("0L") + F.floor(s / 3600).cast("long"), F.floor(F.pmod(s, F.lit(3600)) / 60).cast("long"), F.pmod(s, F.lit(60)))


def without_last_part(name: Column, separator: str = "_") -> Column:
    return F.regexp_replace(name, f"{separator}[^{separator}]*$", "")


def has_zone(text: Column) -> Column:
    return text.rlike(r"(Z|[+-]\d\d:?\d\d)$")


def safe_component(text: Column) -> Column:
    """One non-empty path component."""
    return ~text.contains("/") & ~text.isin("", ".", "..")


def transient_name(name: Column) -> Column:
    return F.lower(name).rlike(r"(\.tmp|\.partial|\.lock|\.part|~)$|^\.|\.tmp\.|in[_-]?progress")


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, v: s + v)


def apply_3x4(matrix: Column, x: Column, y: Column, z: Column) -> tuple[Column, Column, Column]:
    """A 3x4 matrix (12 numbers by row) times a point."""
    row = lambda i: matrix[4 * i] * x + matrix[4 * i + 1] * y + matrix[4 * i + 2] * z + matrix[4 * i + 3]
    return row(0), row(1), row(2)


def project(k: Column, e: Column, x: Column, y: Column, z: Column) -> tuple[Column, Column, Column]:
    """Pixel coordinates and depth of a point: k has 9 numbers by row, e 12."""
    cx, cy, cz = apply_3x4(e, x, y, z)
    u = k[0] * cx + k[1] * cy + k[2] * cz
    v = k[3] * cx + k[4] * cy + k[5] * cz
    w = k[6] * cx + k[7] * cy + k[8] * cz
    return F.try_divide(u, w), F.try_divide(v, w), cz
