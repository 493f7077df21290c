"""Independent SQL for the queries, for an engine that has the tables as views."""

from __future__ import annotations

from collections.abc import Sequence

from runnel.schema import MONTH_NAMES, MONTHS, SITE_COLUMNS

MID = [f"i_mid_{m}" for m in MONTHS]
RUNOFF = [f"runoff_{m}" for m in MONTHS]
# The columns at file positions 4, 7, ..., 37 and 40, 41, ..., 51.
POSITIONAL_MID = [
    "i_high", "i_high_jan", "i_high_feb", "i_high_mar", "i_high_apr", "i_high_may", "i_high_jun", "i_high_jul", "i_high_aug", "i_high_sep", "i_high_oct", "i_high_nov",
]
POSITIONAL_RUNOFF = [
    "i_high_dec", "runoff_jan", "runoff_feb", "runoff_mar", "runoff_apr", "runoff_may", "runoff_jun", "runoff_jul", "runoff_aug", "runoff_sep", "runoff_oct", "runoff_nov",
]
# The column dictionary, and the part of it that repeats every month.
DICTIONARY = [
    ("X", "longitude", "decimal degrees"),
    ("Y", "latitude", "decimal degrees"),
    ("i_mid", "mid estimate of the microplastic concentration", "particles/km2"),
    ("i_low", "low estimate of the microplastic concentration", "particles/km2"),
    ("i_high", "high estimate of the microplastic concentration", "particles/km2"),
]
DICTIONARY_OF_MONTH = [
    ("i_mid_", "mid estimate of the microplastic concentration in ", "particles/km2"),
    ("i_low_", "low estimate of the microplastic concentration in ", "particles/km2"),
    ("i_high_", "high estimate of the microplastic concentration in ", "particles/km2"),
]
MONTH_TITLES = ["January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November", "December"]
CENTS = "CAST(round(l_extendedprice * 100) AS BIGINT)"


def _site_view() -> str:
    of_month = "SUM(CASE WHEN month(l_shipdate) = {i} THEN {v} ELSE 0 END)"
    sums = [of_month.format(i=i, v=CENTS) + f" AS c_{m}" for i, m in enumerate(MONTHS, 1)]
    sums += [of_month.format(i=i, v="CAST(l_quantity AS BIGINT)") + f" AS q_{m}" for i, m in enumerate(MONTHS, 1)]
    scale = {"mid": "", "low": " * 0.5", "high": " * 2.0"}
    year = "CAST(cents AS DOUBLE) / 4999999.0"
    values = {
        "X": "CAST(k * 7919 % 200 - 100 AS DOUBLE) / 10.0",
        "Y": "CAST(k * 104729 % 160 - 80 AS DOUBLE) / 10.0",
        "mpw": "p_retailprice",
        "area": "CAST(CASE WHEN p_size % 10 = 0 THEN 0 ELSE p_size END AS DOUBLE) * 1000000.0",
    }
    for e, f in scale.items():
        missing = "WHEN k % 17 = 0 THEN NULL " if e == "mid" else ""
        values[f"i_{e}"] = f"CASE {missing}WHEN k % 13 = 0 THEN 0.0 ELSE {year}{f} END"
        for m in MONTHS:
            values[f"i_{e}_{m}"] = f"CAST(c_{m} AS DOUBLE) / 4999999.0{f}"
    for m in MONTHS:
        values[f"runoff_{m}"] = f"CAST(q_{m} AS DOUBLE)"
    columns = ",\n  ".join(f'CAST({values[c]} AS DOUBLE) AS "{c}"' for c in SITE_COLUMNS)
    return f"""totals AS (
  SELECT l_partkey AS k, SUM({CENTS}) AS cents, {", ".join(sums)}
  FROM lineitem GROUP BY l_partkey),
site AS (
  SELECT k AS site_id, {columns}
  FROM totals JOIN part ON k = p_partkey)"""


SITE = _site_view()


def _on_site(body: str, *ctes: str) -> str:
    return "WITH " + ",\n".join([SITE, *ctes]) + "\n" + body


def _union(parts: Sequence[str]) -> str:
    return "\nUNION ALL ".join(parts)


def _long(columns: Sequence[str], labels: Sequence[str] = MONTHS, more: str = "") -> str:
    return _union(
        [f'SELECT site_id, "X", "Y"{more}, \'{m}\' AS month, "{c}" AS v FROM site' for c, m in zip(columns, labels)]
    )


def _seasonal(columns: Sequence[str], source: str = "site") -> str:
    long = _union([f"SELECT '{m}' AS month, \"{c}\" AS v FROM {source}" for c, m in zip(columns, MONTHS)])
    return f"""SELECT month, round(avg(v), 6) AS average_pollution, round(max(v), 6) AS max_pollution,
  round(min(v), 6) AS min_pollution, round(stddev_pop(v), 6) AS std_deviation,
  count(*) AS active_locations, round(sum(v), 6) AS total_pollution
FROM ({long}) WHERE v > 0 GROUP BY month"""


DENSITY = "CASE WHEN area > 0 THEN i_mid / (area / 1000000.0) ELSE 0.0 END"
KEY = """CAST("X" AS VARCHAR) || ',' || CAST("Y" AS VARCHAR)"""


def _cells(size: float) -> list[str]:
    corner = "round(CAST(trunc({c} / {s}) AS BIGINT) * {s}, 4)"
    x, y = corner.format(c='"X"', s=size), corner.format(c='"Y"', s=size)
    return [
        f"""points AS (SELECT site_id, "X", "Y", {KEY} AS location, i_mid AS pollution, {DENSITY} AS density,
  'grid_' || CAST({x} AS VARCHAR) || '_' || CAST({y} AS VARCHAR) AS grid FROM site WHERE i_mid > 0.01)""",
        """cells AS (SELECT grid, count(*) AS n, sum(pollution) AS total, avg(density) AS mean,
  max(pollution) AS largest FROM points GROUP BY grid)""",
        """hot AS (SELECT *, total * n * mean / 1000.0 AS score FROM cells
  WHERE n >= 2 AND total * n * mean / 1000.0 > 0.1)""",
        """listed AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY grid ORDER BY "X", "Y") AS r
  FROM points) WHERE r <= 5)""",
    ]


def _hotspots(size: float) -> str:
    return _on_site(
        """SELECT grid, n AS locations_count, round(total, 6) AS total_pollution, round(mean, 6) AS average_density,
  round(largest, 6) AS max_pollution, round(score, 6) AS hotspot_score,
  (SELECT string_agg(location, ';' ORDER BY r) FROM listed WHERE listed.grid = hot.grid) AS sample_locations
FROM hot""",
        *_cells(size),
    )


def _variance() -> str:
    values = ", ".join(MID)
    positive = f"list_filter([{values}], lambda v: v > 0)"
    return f"CASE WHEN len({positive}) > 1 THEN list_var_pop({positive}) ELSE 0.0 END"


FEATURES = f"""features AS (SELECT site_id, "X", "Y", {KEY} AS location, i_mid AS pollution, {DENSITY} AS density,
  {_variance()} AS variance FROM site WHERE i_mid > 0)"""
LIMITS = """sorted AS (SELECT list_sort(list(pollution)) AS l, count(*) AS n FROM features),
limits AS (SELECT n AS count, l[CAST(floor(n * 0.25) AS INT) + 1] AS low, l[CAST(floor(n * 0.5) AS INT) + 1] AS medium,
  l[CAST(floor(n * 0.75) AS INT) + 1] AS high, l[CAST(floor(n * 0.9) AS INT) + 1] AS critical FROM sorted)"""
CLASSED = """classed AS (SELECT features.*, CASE WHEN pollution <= low THEN 'LOW' WHEN pollution <= medium THEN 'MEDIUM'
  WHEN pollution <= high THEN 'HIGH' ELSE 'CRITICAL' END AS category FROM features, limits)"""


def _correlations(pairs: Sequence[tuple[str, str]]) -> list[str]:
    long = _union([f'SELECT site_id, "X", "Y", "{p}" AS p, "{r}" AS r FROM site' for p, r in pairs])
    return [
        f"pairs AS (SELECT * FROM ({long}) WHERE p > 0 AND r > 0)",
        "enough AS (SELECT site_id FROM pairs GROUP BY site_id HAVING count(*) >= 3)",
        """moments AS (SELECT "X", "Y", CAST(count(*) AS DOUBLE) AS n, sum(p) AS sp, sum(r) AS sr, sum(p * p) AS spp,
  sum(r * r) AS srr, sum(p * r) AS spr FROM pairs WHERE site_id IN (SELECT site_id FROM enough) GROUP BY "X", "Y")""",
        f"""correlations AS (SELECT "X" AS x, "Y" AS y, {KEY} AS location,
  round((n * spr - sp * sr) / sqrt((n * spp - sp * sp) * (n * srr - sr * sr)), 4) AS correlation,
  CAST(n AS BIGINT) AS data_points, round(sp / n, 6) AS avg_pollution, round(sr / n, 6) AS avg_runoff
  FROM moments WHERE (n * spp - sp * sp) * (n * srr - sr * sr) > 0)""",
    ]


def _correlation_report(pairs: Sequence[tuple[str, str]]) -> str:
    return _on_site(
        """SELECT strength, count(*) AS total_locations,
  count(*) FILTER (WHERE correlation > 0) AS positive_correlations,
  count(*) FILTER (WHERE correlation < 0) AS negative_correlations,
  round(avg(correlation), 4) AS avg_correlation, round(avg(avg_pollution), 6) AS avg_pollution,
  round(avg(avg_runoff), 6) AS avg_runoff,
  string_agg(location, ';' ORDER BY location) FILTER (WHERE r <= 5) AS sample_locations
FROM (SELECT *, row_number() OVER (PARTITION BY strength ORDER BY location) AS r FROM graded) GROUP BY strength""",
        *_correlations(pairs),
        """graded AS (SELECT *, CASE WHEN abs(correlation) >= 0.7 THEN 'STRONG'
  WHEN abs(correlation) >= 0.4 THEN 'MODERATE' WHEN abs(correlation) >= 0.2 THEN 'WEAK'
  ELSE 'NEGLIGIBLE' END AS strength FROM correlations)""",
    )


def _by_month(k: int) -> list[str]:
    number = " ".join(f"WHEN '{m}' THEN {i}" for i, m in enumerate(MONTHS))
    name = " ".join(f"WHEN '{m}' THEN '{n}'" for m, n in zip(MONTHS, MONTH_NAMES))
    long = _long(MID, more=", i_mid, mpw, area, i_low, i_high")
    return [
        f"""ranked AS (SELECT *, row_number() OVER (PARTITION BY month ORDER BY v DESC, "X", "Y", site_id) AS r
  FROM ({long}) WHERE NOT (i_mid IS NOT DISTINCT FROM 0 AND i_low IS NOT DISTINCT FROM 0
  AND i_high IS NOT DISTINCT FROM 0) AND v IS NOT NULL)""",
        f"""top_months AS (SELECT "X", "Y", i_mid, mpw, area, site_id, month, v AS monthly_input,
  CAST(r AS INTEGER) AS rank, CAST(CASE month {number} END AS INTEGER) AS month_index, CASE month {name} END AS month_name,
  CAST("X" AS VARCHAR) || '_' || CAST("Y" AS VARCHAR) AS river_id,
  CAST(round("X", 2) AS VARCHAR) || '°E, ' || CAST(round("Y", 2) AS VARCHAR) || '°N' AS river_display
  FROM ranked WHERE r <= {k})""",
    ]


TOP = """top_rows AS (SELECT site_id, "X", "Y", i_mid FROM site WHERE i_mid IS NOT NULL
  ORDER BY i_mid DESC, "X", "Y", site_id LIMIT 20)"""
CONCENTRATION = """known AS (SELECT site_id, "X", "Y", i_mid FROM site WHERE i_mid IS NOT NULL),
limits AS (SELECT quantile_cont(i_mid, [0.25, 0.5, 0.75, 0.9]) AS q, quantile_cont(i_mid, 0.95) AS q95 FROM known),
placed AS (SELECT known.*, CASE WHEN i_mid <= q[1] THEN 'Low' WHEN i_mid <= q[2] THEN 'Moderate'
  WHEN i_mid <= q[3] THEN 'High' WHEN i_mid <= q[4] THEN 'Very High' ELSE 'Critical' END AS concentration_category,
  ln(1 + i_mid) AS log_concentration, greatest(3.0, least(20.0, i_mid / q95 * 15.0 + 3.0)) AS size_factor
  FROM known, limits)"""
READINGS = """readings AS (SELECT user_id AS source, event_id AS reading_id, ts, least(value / 1.0007, 100.0) AS cpu_percent,
  CASE WHEN event_id % 11 <> 0 THEN least(value / 1.2503, 100.0) END AS memory_percent,
  least(value / 2.0 + 30.0, 95.0) AS cpu_temp, least(value * 0.6 + 25.0, 95.0) AS gpu_temp FROM events)"""
LATEST = """latest AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY ts DESC, reading_id DESC) AS age,
  FROM readings QUALIFY age <= 50)"""


def _status(metric: str, warning: int, critical: int) -> str:
    return f"""CASE WHEN {metric} < {warning} THEN 'good' WHEN {metric} < {critical} THEN 'warning'
  WHEN {metric} IS NOT NULL THEN 'critical' END AS {metric}_status"""


def _gauge(metric: str, default: int, reference: int, low: int, high: int, threshold: int) -> str:
    value = f"coalesce({metric}, {default}.0)"
    return f"""SELECT source, reading_id, '{metric}' AS metric, {value} AS value, {value} - {reference} AS delta,
  CASE WHEN {value} < {low} THEN 'lightgreen' WHEN {value} < {high} THEN 'yellow' ELSE 'lightcoral' END AS band,
  {value} > {threshold} AS over_threshold FROM readings"""


def _file_round_trip() -> str:
    """Positional read of the mixed-width lines: 54 fields or a bad number drop the row."""
    jan = "CASE WHEN site_id % 11 = 1 THEN NULL ELSE i_mid_jan END AS i_mid_jan"
    rest = ", ".join(MID[1:])
    return _on_site(
        _seasonal(MID, "kept"),
        f"kept AS (SELECT {jan}, {rest} FROM site WHERE site_id % 5 <> 0 AND site_id % 11 <> 0)",
    )


def _months(value: str, column_of, rounding: int, name: str) -> str:
    parts = [
        f"SELECT '{m.capitalize()}' AS month, CAST({i} AS INTEGER) AS month_index, "
        f"round({value.format(c=column_of(m))}, {rounding}) AS {name} FROM site"
        for i, m in enumerate(MONTHS)
    ]
    return _on_site(_union(parts))


def _moments(columns: Sequence[str]) -> str:
    part = """SELECT '{c}' AS "column", count("{c}") AS "count", round(avg("{c}"), 5) AS mean,
  round(stddev_samp("{c}"), 5) AS std, round(min("{c}"), 5) AS min, round(quantile_cont("{c}", 0.25), 5) AS p25,
  round(quantile_cont("{c}", 0.5), 5) AS p50, round(quantile_cont("{c}", 0.75), 5) AS p75,
  round(max("{c}"), 5) AS max FROM site"""
    return _on_site(_union([part.format(c=c) for c in columns]))


def _matrix() -> str:
    pairs = [(a, b) for i, a in enumerate(SITE_COLUMNS) for b in SITE_COLUMNS[:i]]
    row = ", ".join(f'corr("{a}", "{b}") AS r{i}' for i, (a, b) in enumerate(pairs))
    both = _union(
        [
            f"SELECT '{x}' AS column_a, '{y}' AS column_b, round(r{i}, 6) + 0.0 AS r FROM wide"
            for i, (a, b) in enumerate(pairs)
            for x, y in ((a, b), (b, a))
        ]
    )
    same = _union([f"SELECT '{c}' AS column_a, '{c}' AS column_b, 1.0 AS r" for c in SITE_COLUMNS])
    return _on_site(f"{both}\nUNION ALL {same}", f"wide AS (SELECT {row} FROM site)")


def _missing(columns: Sequence[str]) -> str:
    return _union(
        [f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE \"{c}\" IS NULL) AS missing FROM site" for c in columns]
    )


def _described() -> str:
    entries = list(DICTIONARY)
    for title in MONTH_TITLES:
        entries += [(name + title[:3].lower(), meaning + title, unit) for name, meaning, unit in DICTIONARY_OF_MONTH]
    entries += [("runoff_" + title[:3].lower(), "water runoff in " + title, "m3/s") for title in MONTH_TITLES]
    entries += [("mpw", "microplastic weight", "kg"), ("area", "area the site covers", "m2")]
    rows = ", ".join(f"({i}, '{name}', 'double', '{meaning}', '{unit}')" for i, (name, meaning, unit) in enumerate(entries))
    return _on_site(
        """SELECT d."column", CAST(position AS INTEGER) AS position, type, meaning, unit, missing
FROM (VALUES """
        + rows
        + """) AS d(position, "column", type, meaning, unit) JOIN m ON d."column" = m."column" """,
        f"m AS ({_missing(SITE_COLUMNS)})",
    )


def _comma(c: str) -> str:
    """The comma text of a value times 1000 (4 digits), read back as a number."""
    return f"round({c} * 1000, 4)"


def _by_name_file() -> str:
    months = ", ".join(f"CASE WHEN site_id % 7 = 0 THEN NULL ELSE {_comma(c)} END AS {c}" for c in MID)
    return _on_site(f'SELECT site_id, "X", "Y", i_mid, {months}, area FROM site')


def _month_quantiles() -> str:
    part = """SELECT '{m}' AS month, count("{c}") AS "count", round(avg("{c}"), 6) AS mean, round(min("{c}"), 6) AS min,
  round(max("{c}"), 6) AS max, quantile_cont("{c}", [0.25, 0.5, 0.75]) AS q FROM site"""
    long = _union([part.format(m=m, c=c) for m, c in zip(MONTHS, MID)])
    return _on_site(
        f"""SELECT month, "count", mean, min, max, round(q[1], 6) AS p25, round(q[2], 6) AS p50, round(q[3], 6) AS p75,
  round(q[1] - 1.5 * (q[3] - q[1]), 6) AS lower_fence, round(q[3] + 1.5 * (q[3] - q[1]), 6) AS upper_fence
FROM ({long})"""
    )


def _quantile_rows() -> str:
    parts = [
        f"SELECT '{c}' AS \"column\", CAST({p} AS DOUBLE) AS probability, round(quantile_cont({c}, {p}), 6) AS value FROM site"
        for c in ("i_mid", "i_high")
        for p in (0.25, 0.5, 0.75, 0.9)
    ]
    return _on_site(_union(parts))


SURFACE = """SELECT CAST(xn AS INTEGER) AS x_node, CAST(yn AS INTEGER) AS y_node,
  round(x0 + xn * (x1 - x0) / 19, 6) + 0.0 AS x, round(y0 + yn * (y1 - y0) / 19, 6) + 0.0 AS y,
  round(coalesce(m, 0.0), 6) AS level
FROM range(20) AS a(xn), range(20) AS b(yn), extent LEFT JOIN means ON means.xi = xn AND means.yi = yn WHERE n > 100"""


def _surface() -> str:
    return _on_site(
        SURFACE,
        'known AS (SELECT "X" AS x, "Y" AS y, i_mid AS v FROM site WHERE i_mid IS NOT NULL)',
        """extent AS (SELECT min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1, count(*) AS n FROM known)""",
        """means AS (SELECT CAST(floor((x - x0) / (x1 - x0) * 19 + 0.5) AS INTEGER) AS xi,
  CAST(floor((y - y0) / (y1 - y0) * 19 + 0.5) AS INTEGER) AS yi, avg(ln(1 + v)) AS m FROM known, extent GROUP BY 1, 2)""",
    )


def _batch_report() -> str:
    by_name = list(zip(MID, RUNOFF))
    return _on_site(
        f"""SELECT 'seasonal_analysis' AS analysis, month AS key, active_locations AS locations FROM ({_seasonal(MID)})
UNION ALL SELECT 'hotspot_analysis', grid, n FROM hot
UNION ALL SELECT 'severity_classification', category, count(*) FROM classed GROUP BY category
UNION ALL SELECT 'correlation_analysis', CASE WHEN abs(correlation) >= 0.7 THEN 'STRONG'
  WHEN abs(correlation) >= 0.4 THEN 'MODERATE' WHEN abs(correlation) >= 0.2 THEN 'WEAK'
  ELSE 'NEGLIGIBLE' END, count(*) FROM correlations GROUP BY 2""",
        *_cells(0.1),
        FEATURES,
        LIMITS,
        CLASSED,
        *_correlations(by_name),
    )


def oracle_sql() -> dict[str, str]:
    by_name = list(zip(MID, RUNOFF))
    positional = list(zip(POSITIONAL_MID, POSITIONAL_RUNOFF))
    coordinates = 'site_id, "X", "Y"'
    return {
        "seasonal_stats": _on_site(_seasonal(MID)),
        "seasonal_stats_positional": _on_site(_seasonal(POSITIONAL_MID)),
        "seasonal_variance": _on_site(f"SELECT site_id, round({_variance()}, 6) AS variance FROM site"),
        "monthly_totals": _months("sum({c})", lambda m: f"i_mid_{m}", 5, "total"),
        "monthly_mean_runoff": _months("avg({c})", lambda m: f"runoff_{m}", 6, "average"),
        "months_long": _on_site(
            f"""SELECT site_id, month, upper(month[1]) || month[2:] AS title, v AS monthly_input FROM ({_long(MID)})"""
        ),
        "month_pairs": _on_site(
            _union(
                [
                    f"SELECT site_id, '{m}' AS month, i_mid_{m} AS pollution, runoff_{m} AS runoff FROM site"
                    for m in MONTHS
                ]
            )
        ),
        "grid_points": _on_site("SELECT site_id, grid, location, pollution, density FROM points", *_cells(0.5)),
        "site_density": _on_site(f"SELECT site_id, {DENSITY} AS density FROM site"),
        "hotspot_cells": _hotspots(0.5),
        "hotspot_cells_fine": _hotspots(0.1),
        "severity_thresholds": _on_site("SELECT * FROM limits", FEATURES, LIMITS),
        "severity_sites": _on_site(
            "SELECT site_id, pollution, density, round(variance, 6) AS variance, category FROM classed",
            FEATURES,
            LIMITS,
            CLASSED,
        ),
        "severity_report": _on_site(
            """SELECT category, count(*) AS count, round(avg(pollution), 6) AS avg_pollution,
  round(avg(density), 6) AS avg_density,
  string_agg(location, ';' ORDER BY r) FILTER (WHERE r <= 10) AS sample_locations
FROM (SELECT *, row_number() OVER (PARTITION BY category ORDER BY "X", "Y") AS r FROM classed) GROUP BY category""",
            FEATURES,
            LIMITS,
            CLASSED,
        ),
        "correlation_sites": _on_site(
            "SELECT x, y, correlation, data_points, avg_pollution, avg_runoff FROM correlations",
            *_correlations(by_name),
        ),
        "correlation_report": _correlation_report(by_name),
        "correlation_report_positional": _correlation_report(positional),
        "correlation_matrix": _matrix(),
        "numeric_summary": _moments(SITE_COLUMNS),
        "missing_by_column": _on_site(_missing(["site_id", *SITE_COLUMNS])),
        "missing_total": _on_site(f"SELECT CAST(sum(missing) AS BIGINT) AS missing FROM ({_missing(SITE_COLUMNS)})"),
        "described_columns": _described(),
        "table_shape": _on_site("SELECT count(*) AS rows, CAST(55 AS INTEGER) AS columns FROM site"),
        "completeness": _on_site(
            """SELECT "rows", coordinate_quality, round(concentration_quality, 6) AS concentration_quality,
  round((coordinate_quality + concentration_quality) / 2, 6) AS score,
  CASE WHEN (coordinate_quality + concentration_quality) / 2 < 50 THEN 'low'
    WHEN (coordinate_quality + concentration_quality) / 2 < 80 THEN 'medium' ELSE 'high' END AS band,
  round((coordinate_quality + concentration_quality) / 2 - 90, 6) AS delta,
  (coordinate_quality + concentration_quality) / 2 >= 90 AS on_target
FROM (SELECT count(*) AS "rows", 100.0 * count(*) FILTER (WHERE "X" IS NOT NULL AND "Y" IS NOT NULL) / count(*)
  AS coordinate_quality, 100.0 * count(i_mid) / count(*) AS concentration_quality FROM site)"""
        ),
        "clean_sites": _on_site(f"SELECT {coordinates}, i_mid FROM site WHERE i_mid IS NOT NULL"),
        "quantile_95": _on_site("""SELECT 'i_mid' AS "column", round(quantile_cont(i_mid, 0.95), 6) AS q95 FROM site"""),
        "quantile_vector": _quantile_rows(),
        "month_distribution": _month_quantiles(),
        "high_estimate_histogram": _on_site(
            """SELECT CAST(bin AS INTEGER) AS bin, round(low + (bin - 1) * width, 6) AS bin_start,
  round(low + bin * width, 6) AS bin_end, count(*) AS count
FROM (SELECT least(floor((i_high - low) / (high - low) * 30), 29) + 1 AS bin, low, (high - low) / 30 AS width
  FROM site, (SELECT min(i_high) AS low, max(i_high) AS high FROM site)) GROUP BY bin, low, width"""
        ),
        "high_estimate_extremes": _on_site(
            """SELECT min, max, CASE WHEN min = 0 THEN FALSE ELSE max / min > 100 END AS log_scale
FROM (SELECT min(i_high) AS min, max(i_high) AS max FROM site)"""
        ),
        "largest_site": _on_site(f"SELECT {coordinates}, i_mid FROM top_rows ORDER BY i_mid DESC, 2, 3, 1 LIMIT 1", TOP),
        "trend_surface": _surface(),
        "top_sites": _on_site(f"SELECT {coordinates}, i_mid FROM top_rows", TOP),
        "top_sites_view": _on_site(
            """SELECT *, CAST(CASE WHEN max_y - min_y < 5 AND max_x - min_x < 5 THEN 8
  WHEN max_y - min_y < 10 AND max_x - min_x < 10 THEN 6 WHEN max_y - min_y > 50 OR max_x - min_x > 50 THEN 2
  ELSE 3 END AS INTEGER) AS zoom
FROM (SELECT round(avg("Y"), 6) AS center_y, round(avg("X"), 6) AS center_x, min("X") AS min_x, max("X") AS max_x,
  min("Y") AS min_y, max("Y") AS max_y FROM top_rows)""",
            TOP,
        ),
        "top_sites_scaled": _on_site(
            f"""SELECT {coordinates}, round(i_mid, 6) AS i_mid, round(greatest(0.5, i_mid / CASE WHEN top <= 0 THEN 5000
  WHEN top < 10 THEN 0.5 WHEN top < 100 THEN 5 WHEN top < 1000 THEN 50 WHEN top < 10000 THEN 500 ELSE 5000 END), 6)
  AS radius, 'Pollution: ' || printf('%.2f', i_mid) || ' particles/km²' AS popup
FROM top_rows, (SELECT max(i_mid) AS top FROM top_rows)""",
            TOP,
        ),
        "top_sites_colored": _on_site(
            f"""SELECT {coordinates}, i_mid, round(t, 6) AS intensity,
  '#' || printf('%02x', CAST(trunc(255 * t) AS INTEGER)) || printf('%02x', CAST(trunc(255 * (1 - t)) AS INTEGER)) || '00'
  AS color, round(greatest(5.0, least(25.0, 5.0 + i_mid / high * 20.0)), 6) AS radius,
  CASE WHEN t > 0.8 THEN 'Critical' WHEN t > 0.5 THEN 'High' ELSE 'Moderate' END AS severity,
  printf('%.2f', i_mid) || ' particles/km²' AS concentration,
  printf('%.3f', "Y") || ', ' || printf('%.3f', "X") AS coordinates
FROM (SELECT *, (i_mid - low) / (high - low) AS t
  FROM top_rows, (SELECT min(i_mid) AS low, max(i_mid) AS high FROM top_rows))""",
            TOP,
        ),
        "heat_points": _on_site('SELECT "Y", "X", i_mid AS weight, site_id FROM site WHERE i_mid > 0'),
        "heat_points_capped": _on_site(
            """SELECT "Y", "X", round(least(i_mid / q95, 1.0), 6) AS weight, site_id
FROM site, (SELECT quantile_cont(i_mid, 0.95) AS q95 FROM site) WHERE i_mid > 0"""
        ),
        "heat_center": _on_site(
            'SELECT round(avg("Y"), 6) AS center_y, round(avg("X"), 6) AS center_x FROM site WHERE i_mid IS NOT NULL'
        ),
        "nonzero_sites": _on_site(
            f"""SELECT {coordinates}, i_mid, i_low, i_high FROM site WHERE NOT (i_mid IS NOT DISTINCT FROM 0
  AND i_low IS NOT DISTINCT FROM 0 AND i_high IS NOT DISTINCT FROM 0)"""
        ),
        "top_sites_by_month": _on_site("SELECT * FROM top_months", *_by_month(20)),
        "top_sites_by_month_short": _on_site("SELECT * FROM top_months", *_by_month(15)),
        "month_axis_limit": _on_site(
            "SELECT round(max(monthly_input) * 1.1, 6) AS axis_limit FROM top_months", *_by_month(15)
        ),
        "severity_table": _on_site(
            """SELECT area, i_high, runoff_jul, mpw, site_id, round(mpw / top * 20 + 5, 6) AS marker_size,
  area > 0 AND i_high > 0 AS on_log_axes FROM site, (SELECT max(mpw) AS top FROM site)"""
        ),
        "weight_vs_runoff": _on_site("SELECT mpw, runoff_jul, i_mid, site_id FROM site"),
        "risk_table": _on_site(
            """SELECT i_high, mpw, site_id, round(risk, 9) AS risk, round(risk / top * 30 + 5, 6) AS marker_size
FROM scored, (SELECT max(risk) AS top FROM scored)""",
            """scored AS (SELECT i_high, mpw, site_id, CASE WHEN area <> 0 THEN i_high * mpw / area END AS risk FROM site)""",
        ),
        "area_vs_weight": _on_site("SELECT area, mpw, i_mid, site_id FROM site WHERE i_mid IS NOT NULL"),
        "runoff_long": _on_site(
            f"""SELECT "X", "Y", site_id, upper(month[1]) || month[2:] AS "Month", v AS "Runoff"
FROM ({_long(RUNOFF)}) WHERE v IS NOT NULL"""
        ),
        "concentration_points": _on_site(
            """SELECT "X", "Y", i_mid, site_id, round(log_concentration, 6) AS log_concentration,
  round(size_factor, 6) AS size_factor, concentration_category FROM placed""",
            CONCENTRATION,
        ),
        "concentration_counts": _on_site(
            """SELECT concentration_category, count(*) AS points,
  concentration_category || ' (' || CAST(count(*) AS VARCHAR) || ' points)' AS label
FROM placed GROUP BY concentration_category""",
            CONCENTRATION,
        ),
        "concentration_labels": _on_site(
            """SELECT site_id, printf('%.2f', "X") || '°E, ' || printf('%.2f', "Y") || '°N' AS location_text,
  printf('%.2f', i_mid) || ' particles/km²' AS concentration_text, printf('%.2f', log_concentration) AS log_text
FROM placed""",
            CONCENTRATION,
        ),
        "sample_share": _on_site(
            f"SELECT {coordinates}, i_mid FROM site ORDER BY md5('42|' || CAST(site_id AS VARCHAR)) LIMIT 1000"
        ),
        "sample_rows": _on_site(
            f"SELECT {coordinates}, i_mid FROM site ORDER BY md5('42|' || CAST(site_id AS VARCHAR)) LIMIT 1500"
        ),
        "first_sites": _on_site(f'SELECT {coordinates}, i_mid FROM site ORDER BY "X", "Y", site_id LIMIT 20'),
        "sites_by_name_file": _by_name_file(),
        "sites_positional_file": _file_round_trip(),
        "sites_unlike_files": _on_site('SELECT site_id, "X", "Y", i_mid, area, mpw FROM site'),
        "monthly_totals_file": _months(
            "sum({c})", lambda m: "CASE WHEN site_id % 11 <> 1 THEN i_mid_jan END" if m == "jan" else f"i_mid_{m}", 5, "total"
        ),
        "report_faulty_lines": _on_site(
            """SELECT 'point' AS kind, 'g' || site_id AS name, "Y" AS latitude, "X" AS longitude FROM site WHERE site_id % 4 >= 2
UNION ALL SELECT 'point', 'g' || site_id, "X", "Y" FROM site WHERE site_id % 4 = 2
UNION ALL SELECT ['no tab', 'bad json', '', 'bad coordinate'][site_id % 4 + 1], 'g' || site_id, NULL, NULL FROM site
  WHERE site_id % 4 <> 2"""
        ),
        "report_extension": _on_site(
            """SELECT CASE WHEN "X" > 0 THEN 'true' ELSE 'false' END AS side, round(sum(mpw), 4) AS weight, count(*) AS n,
  CAST(CASE WHEN "X" > 0 THEN 2 ELSE 1 END AS INTEGER) AS line FROM site GROUP BY 1, 4"""
        ),
        "numeric_repair": _on_site(
            f"""SELECT site_id, {_comma("i_mid_jan")} AS i_mid_jan, CASE WHEN site_id % 3 <> 0 THEN i_mid END AS i_mid,
  greatest(0.0, least(5000.0, {_comma("i_mid_jan")})) AS scaled FROM site"""
        ),
        "hotspot_points_file": _on_site(
            """SELECT "Y" AS latitude, "X" AS longitude, round(score, 6) AS hotspot_score, grid
FROM listed JOIN hot USING (grid)""",
            *_cells(0.5),
        ),
        "batch_report": _batch_report(),
        "readings_status": f"""WITH {READINGS} SELECT * EXCLUDE (ts), {_status("cpu_percent", 70, 90)},
  {_status("memory_percent", 70, 90)}, {_status("cpu_temp", 70, 85)} FROM readings""",
        "readings_alerts": f"""WITH {READINGS} SELECT source, reading_id, cpu_temp, gpu_temp FROM readings
WHERE cpu_temp > 70 OR gpu_temp > 75""",
        "readings_gauges": f"WITH {READINGS} "
        + _union(
            [
                _gauge("cpu_percent", 0, 50, 30, 70, 90),
                _gauge("memory_percent", 0, 60, 40, 80, 85),
                _gauge("cpu_temp", 45, 50, 50, 70, 80),
                _gauge("gpu_temp", 40, 55, 55, 75, 85),
            ]
        ),
        "readings_latest": f"WITH {READINGS}, {LATEST} SELECT source, reading_id FROM latest",
        "readings_history": f"""WITH {READINGS}, {LATEST},
numbered AS (SELECT *, count(*) OVER (PARTITION BY source) AS kept FROM latest)
SELECT *, value > 70 AS over_line FROM ("""
        + _union(
            [
                f"SELECT source, CAST(kept - age AS INTEGER) AS reading_index, '{m}' AS metric, {m} AS value "
                "FROM numbered WHERE kept >= 2"
                for m in ("cpu_percent", "memory_percent", "cpu_temp", "gpu_temp")
            ]
        )
        + ")",
        "readings_history_stream": f"WITH {READINGS}, {LATEST} SELECT source, reading_id FROM latest",
        "readings_text": f"""WITH {READINGS} SELECT reading_id, printf('%.1f', cpu_percent) || '%' AS cpu_percent,
  printf('%.1f', memory_percent) || '%' AS memory_percent FROM readings""",
    }
