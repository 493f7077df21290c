"""Spark operators for wide environmental site tables.

One row describes one site: coordinates, annual and monthly low/mid/high
estimates, monthly runoff, a weight and an area. Operators take DataFrames and
return DataFrames; see the README for the map of modules.
"""

from runnel.schema import BY_NAME, MONTHS, POSITIONAL, SITE_COLUMNS, SITE_SCHEMA, MonthColumns, SiteRoles

__all__ = ["BY_NAME", "MONTHS", "POSITIONAL", "SITE_COLUMNS", "SITE_SCHEMA", "MonthColumns", "SiteRoles"]
