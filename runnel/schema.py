"""The site table: column order, column roles, month presets, dictionary."""

from __future__ import annotations

from dataclasses import dataclass
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Month labels and names, in calendar order.
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")
MONTH_NAMES = (
    "January", "February", "March", "April", "May", "June",
    "July", "August", "September", "October", "November", "December",
)

ESTIMATES = ("mid", "low", "high")

#: The 55 columns of a site file, in file order.
SITE_COLUMNS: tuple[str, ...] = (
    "X",
    "Y",
    *(f"i_{e}" for e in ESTIMATES),
    *(f"i_{e}_{m}" for m in MONTHS for e in ESTIMATES),
    *(f"runoff_{m}" for m in MONTHS),
    "mpw",
    "area",
)


class MonthColumns(NamedTuple):
    """The columns that stand for one month."""

    label: str
    pollution: str
    runoff: str


#: Month columns as the file header documents them.
BY_NAME: tuple[MonthColumns, ...] = tuple(MonthColumns(m, f"i_mid_{m}", f"runoff_{m}") for m in MONTHS)

#: Month columns at file positions 4, 7, ..., 37 and 40, ..., 51. These are not
#: the columns the labels promise; the preset exists to reproduce reports that
#: were made from these positions.
POSITIONAL: tuple[MonthColumns, ...] = tuple(
    MonthColumns(m, SITE_COLUMNS[4 + 3 * i], SITE_COLUMNS[40 + i]) for i, m in enumerate(MONTHS)
)


@dataclass(frozen=True)
class SiteRoles:
    """Which column plays which part, so operators also run on other tables."""

    x: str = "X"
    y: str = "Y"
    mid: str = "i_mid"
    low: str = "i_low"
    high: str = "i_high"
    weight: str = "mpw"
    area: str = "area"
    months: tuple[MonthColumns, ...] = BY_NAME

    @property
    def pollution_columns(self) -> list[str]:
        return [m.pollution for m in self.months]

    @property
    def runoff_columns(self) -> list[str]:
        return [m.runoff for m in self.months]

    @property
    def labels(self) -> list[str]:
        return [m.label for m in self.months]


DEFAULT_ROLES = SiteRoles()


def _describe(column: str) -> tuple[str, str]:
    """Meaning and unit of a site column."""
    fixed = {
        "X": ("longitude", "decimal degrees"),
        "Y": ("latitude", "decimal degrees"),
        "mpw": ("microplastic weight", "kg"),
        "area": ("area the site covers", "m2"),
    }
    if column in fixed:
        return fixed[column]
    kind, _, rest = column.partition("_")
    if kind == "runoff":
        return f"water runoff in {MONTH_NAMES[MONTHS.index(rest)]}", "m3/s"
    estimate, _, month = rest.partition("_")
    meaning = f"{estimate} estimate of the microplastic concentration"
    if month:
        meaning += f" in {MONTH_NAMES[MONTHS.index(month)]}"
    return meaning, "particles/km2"


SITE_SCHEMA = T.StructType(
    [
        T.StructField(c, T.DoubleType(), True, {"comment": _describe(c)[0], "unit": _describe(c)[1]})
        for c in SITE_COLUMNS
    ]
)


def describe_columns(spark: SparkSession, schema: T.StructType = SITE_SCHEMA) -> DataFrame:
    """The column dictionary: position, name, type, meaning and unit.

    Meaning and unit come from the field metadata, so the dictionary of any
    DataFrame that kept them can be listed by passing its schema.
    """
    rows = [
        (i, f.name, f.dataType.simpleString(), f.metadata.get("comment"), f.metadata.get("unit"))
        for i, f in enumerate(schema.fields)
    ]
    return spark.createDataFrame(rows, "position int, column string, type string, meaning string, unit string")
