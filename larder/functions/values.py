"""Helpers on JSON-like values: presence, numeric tests, safe arithmetic."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often the expression refers to it.

    Branches of a conditional do not share common subexpressions; a lambda variable does.
    """
    return F.transform(F.array(value), use)[0]


def parse_json(text: Column | str) -> Column:
    """VARIANT of a JSON text, null when it is malformed."""
    return F.try_parse_json(_col(text))


def root_type(v: Column | str) -> Column:
    """``object``, ``array``, ``null`` or ``scalar`` for a VARIANT; null for a missing one."""
    s = F.schema_of_variant(_col(v))
    return (
        F.when(s.startswith("OBJECT"), F.lit("object"))
        .when(s.startswith("ARRAY"), F.lit("array"))
        .when(s == "VOID", F.lit("null"))
        .when(s.isNotNull(), F.lit("scalar"))
    )


def is_present(v: Column | str) -> Column:
    """True for a VARIANT that exists and is not the JSON null."""
    c = _col(v)
    return c.isNotNull() & ~F.is_variant_null(c)


def finite_number(v: Column | str, path: str = "$") -> Column:
    """Value at ``path`` as double when the JSON type is a number and it is finite, else null.

    The type is tested first because a cast would also accept the string ``"12"`` and booleans.
    """
    item = F.try_variant_get(_col(v), path, "variant")
    numeric = F.schema_of_variant(item).rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)")
    d = F.try_variant_get(item, "$", "double")
    finite = (F.abs(d) < F.lit(float("inf"))) & ~F.isnan(d)
    return F.when(numeric & finite, d)


def finite_numbers(v: Column | str, names: Sequence[str]) -> Column:
    """Array of the finite numbers at the given fields of a VARIANT, null where there is none.

    The value is bound to a lambda variable, so however many fields are read it is computed once.
    """
    c = _col(v)
    return bind(c, lambda t: F.array(*[finite_number(t, f"$.{n}") for n in names]))


def first_present_value(fields: Column | str, names: Sequence[str]) -> Column:
    """Value of the first candidate that the map holds with a non-null value, else null."""
    f = _col(fields)
    return F.coalesce(*[F.when(is_present(f[n]), f[n]) for n in names])


def first_present(fields: Column | str, names: Sequence[str]) -> Column:
    """Name of the first candidate that the map holds with a non-null value, else null."""
    f = _col(fields)
    return F.coalesce(*[F.when(is_present(f[n]), F.lit(n)) for n in names])


def aspect_ratio(width: Column | str, height: Column | str) -> Column:
    return F.coalesce(F.try_divide(_col(width).cast("double"), _col(height).cast("double")), F.lit(0.0))


def metadata_json(*columns: Column | str) -> Column:
    """JSON object of the non-null columns."""
    return F.to_json(F.struct(*columns))


def fold_numbers(v: Column | str) -> Column:
    """JSON text of a VARIANT with integral decimals printed as integers."""
    return F.to_json(_col(v))
