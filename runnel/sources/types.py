"""Types of text columns, found from their values in one scan.

Each value allows a set of types; a column allows what all its values allow.
Sets are bits and meet by ``bit_and``, which takes values, tasks and files in any
order and grouping, so types of files that were looked at before can be merged
without reading them again.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runnel.functions.values import parse_float_sql, quoted

# Texts that stand for a missing value.
MISSING = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA",
    "NULL", "NaN", "None", "n/a", "nan", "null",
)

#: Types from the narrowest to the widest, with their bits; a text that allows none of them is a string.
BITS = {"boolean": 1, "bigint": 2, "double": 4, "timestamp_ntz": 8}
TEXT = "string"
#: What a missing value allows.
ANYTHING = sum(BITS.values())


def present_sql(c: str) -> str:
    """The text, or NULL where it stands for a missing value."""
    missing = ", ".join(f"'{m}'" for m in MISSING)
    return f"case when {c} not in ({missing}) then {c} end"


def cast_sql(c: str, data_type: str) -> str:
    """A present text as a value of a type; NULL where it is none."""
    if data_type == "boolean":
        return f"case when {c} in ('True', 'TRUE', 'true') then true when {c} in ('False', 'FALSE', 'false') then false end"
    if data_type == "bigint":
        return f"case when {c} rlike '^ *[+-]?[0-9]+ *$' then try_cast(trim({c}) as bigint) end"
    if data_type == "double":
        return parse_float_sql(c)
    if data_type == "timestamp_ntz":
        day, time = r"[0-9]{4}-[0-9]{2}-[0-9]{2}", r"[0-9]{2}:[0-9]{2}(:[0-9]{2}([.][0-9]{1,6})?)?"
        return f"case when {c} rlike '^{day}([T ]{time})?$' then try_cast({c} as timestamp_ntz) end"
    return c


def allowed_sql(c: str) -> str:
    """Bits of the types that a text may be read as."""
    fits = [f"case when ({cast_sql(c, t)}) is not null then {bit} else 0 end" for t, bit in BITS.items()]
    return f"case when {c} is not null then {' + '.join(fits)} end"


def type_bits(raw: DataFrame, columns: Sequence[str], by: Sequence[Column] = ()) -> DataFrame:
    """(by..., column, bits, present): what the values of each text column allow, and how many there are; one scan.

    Without ``by`` there is one row per column. A column without any value allows anything.
    """
    texts = raw.select(*by, *[F.expr(present_sql(quoted(c))).alias(f"_{i}") for i, c in enumerate(columns)])
    names = [c for c in texts.columns if c not in {f"_{i}" for i in range(len(columns))}]
    wide = texts.groupBy(*[quoted(n) for n in names]).agg(
        *[F.expr(f"coalesce(bit_and({allowed_sql(f'_{i}')}), {ANYTHING})").alias(f"b{i}") for i in range(len(columns))],
        *[F.count(f"_{i}").alias(f"n{i}") for i in range(len(columns))],
    )
    rows = [F.struct(F.lit(c).alias("column"), F.col(f"b{i}").alias("bits"), F.col(f"n{i}").alias("present")) for i, c in enumerate(columns)]
    return wide.select(*[quoted(n) for n in names], F.inline(F.array(*rows)))


def merged_bits(bits: DataFrame) -> DataFrame:
    """(column, bits, present) over all rows of a column, for instance those of several files."""
    return bits.groupBy("column").agg(F.expr("bit_and(bits)").alias("bits"), F.sum("present").alias("present"))


def named_type(bits: Column | str = "bits") -> Column:
    """The narrowest type that the bits allow; a column of missing values only is double."""
    b = F.col(bits) if isinstance(bits, str) else bits
    out = F.when(b == ANYTHING, "double")
    for name, bit in BITS.items():
        out = out.when(b.bitwiseAND(bit) > 0, name)
    return out.otherwise(TEXT)


def infer_types(raw: DataFrame, columns: Sequence[str]) -> dict[str, str]:
    """The type of each text column over all rows (runs a job)."""
    if not columns:
        return {}
    return dict(type_bits(raw, columns).select("column", named_type()).collect())


def with_types(raw: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Text columns read as the given types; texts that stand for missing values become NULL, as do texts of no such value."""
    return raw.withColumns({c: F.expr(cast_sql(f"({present_sql(quoted(c))})", t)) for c, t in types.items()})
