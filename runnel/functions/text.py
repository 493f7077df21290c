"""Text column expressions: labels, site keys, number text, JSON text.

Arguments are SQL text, a column name or an expression.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runnel.functions.values import quoted
from runnel.schema import MONTH_NAMES, MONTHS


def number_text_sql(c: str) -> str:
    size = f"abs({c})"
    plain = rf"regexp_replace(cast(cast({c} as decimal(38,20)) as string), '(\\.\\d+?)0*$', '$1')"
    short = rf"replace(cast({c} as string), '.0E', 'E')"
    two_digits = rf"regexp_replace({short}, 'E(-?)(\\d)$', 'E$10$2')"
    return f"""case
        when ({size} >= 1e-4D and {size} < 1e-3D) or ({size} >= 1e7D and {size} < 1e16D) then {plain}
        when ({size} > 0D and {size} < 1e-4D) or ({size} >= 1e16D and {size} < double('inf'))
            then lower(regexp_replace({two_digits}, 'E(\\\\d)', 'E+$1'))
        else cast({c} as string) end"""


def number_text(c: str) -> Column:
    """Shortest decimal text of a double; exponents only below 1e-4 and from 1e16.

    Spark's own cast switches to exponents below 1e-3 and from 1e7.
    """
    return F.expr(number_text_sql(c))


def site_key(x: str, y: str, separator: str = ",") -> Column:
    return F.expr(f"concat({number_text_sql(x)}, '{separator}', {number_text_sql(y)})")


def grid_key(corner_x: str, corner_y: str) -> Column:
    return F.expr(f"concat('grid_', {number_text_sql(corner_x)}, '_', {number_text_sql(corner_y)})")


def display_name(x: str, y: str) -> Column:
    """Coordinates as a label, rounded to two digits."""
    return F.expr(
        f"concat({number_text_sql(f'round({x}, 2)')}, '°E, ', {number_text_sql(f'round({y}, 2)')}, '°N')"
    )


def month_label(name: str) -> Column:
    """``i_mid_jan`` or ``runoff_jan`` to ``jan``."""
    return F.expr(f"substring_index({name}, '_', -1)")


def month_title(label: str) -> Column:
    return F.expr(f"initcap({label})")


def month_full_name(label: str) -> Column:
    entries = ", ".join(f"'{m}', '{n}'" for m, n in zip(MONTHS, MONTH_NAMES))
    return F.expr(f"map({entries})[{label}]")


def month_index(label: str) -> Column:
    entries = ", ".join(f"'{m}', {i}" for i, m in enumerate(MONTHS))
    return F.expr(f"map({entries})[{label}]")


def fixed_sql(c: str, digits: int) -> str:
    return f"case when {c} is not null then format_string('%.{digits}f', {c}) end"


def fixed(c: str, digits: int) -> Column:
    """Number with a fixed count of decimals, as label text."""
    return F.expr(fixed_sql(c, digits))


def ramp_color(intensity: str) -> Column:
    """Green (0) to red (1) as ``#rrgg00``."""

    def byte(share: str) -> str:
        return f"lpad(lower(hex(cast(({share}) * 255D as int))), 2, '0')"

    return F.expr(f"concat('#', {byte(intensity)}, {byte(f'1D - {intensity}')}, '00')")


def _json_text_sql(c: str) -> str:
    """Text as a JSON string: a one-element list without its brackets."""
    return f"substring(to_json(array({c})), 2, length(to_json(array({c}))) - 2)"


def json_value_sql(c: str, data_type: T.DataType) -> str:
    """One column value as JSON text."""
    if isinstance(data_type, (T.DoubleType, T.FloatType)):
        text = number_text_sql(f"cast({c} as double)")
    elif isinstance(data_type, T.StringType):
        text = _json_text_sql(c)
    elif isinstance(data_type, T.ArrayType) and isinstance(data_type.elementType, T.StringType):
        text = f"concat('[', array_join(transform({c}, s -> {_json_text_sql('s')}), ', '), ']')"
    else:
        text = f"cast({c} as string)"
    return f"coalesce({text}, 'null')"


def json_object(fields: list[T.StructField]) -> Column:
    """A row as JSON text with its fields in order."""
    parts = [f"""concat('"{f.name}": ', {json_value_sql(quoted(f.name), f.dataType)})""" for f in fields]
    return F.expr(f"concat('{{', concat_ws(', ', {', '.join(parts)}), '}}')")
