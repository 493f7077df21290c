"""DuckDB SQL with the same rows as the queries of ``source_queries``."""

from __future__ import annotations

from runnel.plans.oracles import CLASSED, FEATURES, LIMITS, MID, READINGS, RUNOFF, _cells, _correlations, _on_site, _seasonal, _union

LATEST = """latest AS (SELECT source, reading_id FROM readings
  QUALIFY row_number() OVER (PARTITION BY source ORDER BY ts DESC, reading_id DESC) <= 50)"""


def _inferred() -> str:
    all_sites = "(SELECT count(*) FROM site)"
    rows = [("site_id", "bigint", all_sites), ("ratio", "double", all_sites), ("seen", "timestamp_ntz", all_sites), ("flag", "boolean", all_sites)]
    rows += [("gaps", "bigint", "(SELECT count(*) FROM site WHERE site_id % 5 <> 0)"), ("widened", "double", all_sites), ("torn", "string", all_sites), ("none", "double", "0")]
    return _on_site(_union([f"SELECT '{c}' AS \"column\", '{t}' AS type, CAST({n} AS BIGINT) AS present" for c, t, n in rows]))


def _inferred_summary() -> str:
    part = """SELECT '{c}' AS "column", count("{c}") AS "count", round(avg("{c}"), 5) AS mean,
  round(stddev_samp("{c}"), 5) AS std, round(CAST(min("{c}") AS DOUBLE), 5) AS min, round(quantile_cont("{c}", 0.25), 5) AS p25,
  round(quantile_cont("{c}", 0.5), 5) AS p50, round(quantile_cont("{c}", 0.75), 5) AS p75,
  round(CAST(max("{c}") AS DOUBLE), 5) AS max FROM further"""
    return _on_site(
        _union([part.format(c=c) for c in ("site_id", "ratio", "gaps", "widened", "none")]),
        """further AS (SELECT CAST(site_id AS DOUBLE) AS site_id, CAST(printf('%.3f', mpw / 7) AS DOUBLE) AS ratio,
  CASE WHEN site_id % 5 <> 0 THEN CAST(site_id AS DOUBLE) END AS gaps, site_id + CASE WHEN site_id % 2 = 0 THEN 0.0 ELSE 0.5 END::DOUBLE AS widened,
  CAST(NULL AS DOUBLE) AS "none" FROM site)""",
    )


def _severity_rows(order: str) -> str:
    return f"""SELECT category, count(*) AS count, round(avg(pollution), 6) AS avg_pollution,
  round(avg(density), 6) AS avg_density,
  string_agg(location, ';' ORDER BY r) FILTER (WHERE r <= 10) AS sample_locations
FROM (SELECT *, row_number() OVER (PARTITION BY category ORDER BY {order}) AS r FROM classed) GROUP BY category"""


HOTSPOT_ROWS = """SELECT grid, n AS locations_count, round(total, 6) AS total_pollution, round(mean, 6) AS average_density,
  round(largest, 6) AS max_pollution, round(score, 6) AS hotspot_score,
  (SELECT string_agg(location, ';' ORDER BY r) FROM listed WHERE listed.grid = hot.grid) AS sample_locations
FROM hot"""

CORRELATION_ROWS = """SELECT strength, count(*) AS total_locations,
  count(*) FILTER (WHERE correlation > 0) AS positive_correlations,
  count(*) FILTER (WHERE correlation < 0) AS negative_correlations,
  round(avg(correlation), 4) AS avg_correlation, round(avg(avg_pollution), 6) AS avg_pollution,
  round(avg(avg_runoff), 6) AS avg_runoff,
  string_agg(location, ';' ORDER BY location) FILTER (WHERE r <= 5) AS sample_locations
FROM (SELECT *, row_number() OVER (PARTITION BY strength ORDER BY location) AS r FROM graded) GROUP BY strength"""

GRADED = """graded AS (SELECT *, CASE WHEN abs(correlation) >= 0.7 THEN 'STRONG'
  WHEN abs(correlation) >= 0.4 THEN 'MODERATE' WHEN abs(correlation) >= 0.2 THEN 'WEAK'
  ELSE 'NEGLIGIBLE' END AS strength FROM correlations)"""


def _report_fields() -> str:
    """All fields of the four reports, line by line in the order of the key."""
    reports = {
        "seasonal_analysis": ("seasonal", "month", "month", "average_pollution max_pollution min_pollution std_deviation active_locations total_pollution"),
        "hotspot_analysis": ("hotspot", "grid", "'HOTSPOT'", "grid locations_count total_pollution average_density max_pollution hotspot_score sample_locations"),
        "severity_classification": ("severity", "category", "category", "count avg_pollution avg_density sample_locations"),
        "correlation_analysis": (
            "correlation", "strength", "strength",
            "total_locations positive_correlations negative_correlations avg_correlation avg_pollution avg_runoff sample_locations",
        ),
    }
    parts = []
    for name, (table, order, key, fields) in reports.items():
        for f in fields.split():
            text = f in ("grid", "sample_locations")
            number = "CAST(NULL AS DOUBLE)" if text else f'round(CAST("{f}" AS DOUBLE), 6)'
            parts.append(
                f"""SELECT '{name}' AS analysis, CAST(row_number() OVER (ORDER BY {order}) AS INTEGER) AS line, {key} AS key, '{f}' AS field,
  {number} AS number, {f'"{f}"' if text else 'NULL'} AS text FROM {table}"""
            )
    return _on_site(
        _union(parts),
        *_cells(0.1), FEATURES, LIMITS, CLASSED, *_correlations(list(zip(MID, RUNOFF))), GRADED,
        f"seasonal AS ({_seasonal(MID)})", f"hotspot AS ({HOTSPOT_ROWS})", f"""severity AS ({_severity_rows('"X", "Y"')})""", f"correlation AS ({CORRELATION_ROWS})",
    )


def _sketched() -> str:
    """The bucket of each exact element, at an error of 0.005 and a least size of 1e-12."""
    base = "ln(1.005 / 0.995)"
    return _on_site(
        f"""SELECT north, "column", p AS probability, round(CASE WHEN b = 0 THEN 0.0 ELSE top * 0.995 END, 6) AS value,
  round(CASE WHEN b = 0 THEN -1e-12 ELSE top * exp(-{base}) END, 6) AS low, round(CASE WHEN b = 0 THEN 1e-12 ELSE top END, 6) AS high,
  round((SELECT count(*) FROM bucketed y WHERE y.north = a.north AND y."column" = a."column" AND y.b = a.b) / n, 6) AS rank_error
FROM (SELECT e.*, 1e-12 * exp((b - 1) * {base}) AS top FROM asked e) a""",
        """long AS (SELECT "Y" >= 0 AS north, 'i_high' AS "column", i_high AS v FROM site UNION ALL SELECT "Y" >= 0, 'mpw', mpw FROM site)""",
        f"bucketed AS (SELECT *, CASE WHEN v <= 1e-12 THEN 0 ELSE ceil(ln(v / 1e-12) / {base}) + 1 END AS b FROM long)",
        """ranked AS (SELECT *, row_number() OVER (PARTITION BY north, "column" ORDER BY v) - 1 AS r, count(*) OVER (PARTITION BY north, "column") AS n FROM bucketed)""",
        """asked AS (SELECT * FROM ranked, (VALUES (0.1::DOUBLE), (0.5::DOUBLE), (0.9::DOUBLE), (1.0::DOUBLE)) AS q(p) WHERE r = floor(p * (n - 1)))""",
    )


def _rejected() -> str:
    counts = {
        ("positional", "lines"): "count(*) + count(*) FILTER (WHERE site_id % 101 = 0)",
        ("positional", "header"): "count(*) FILTER (WHERE site_id % 101 = 0)",
        ("positional", "narrow"): "count(*) FILTER (WHERE site_id % 5 = 0)",
        ("positional", "wide"): "count(*) FILTER (WHERE site_id % 5 = 1)",
        ("positional", "bad_number"): "count(*) FILTER (WHERE site_id % 5 <> 0 AND site_id % 11 = 0)",
        ("named", "rows"): "count(*)",
        ("named", "bad_i_mid_jan"): "count(*) FILTER (WHERE site_id % 7 = 0)",
        ("named", "bad_i_mid_feb"): "count(*) FILTER (WHERE site_id % 7 = 0)",
        ("named", "bad_X"): "0 * count(*)",
        ("named", "bad_area"): "0 * count(*)",
        ("hotspots", "lines"): "count(*)",
        ("hotspots", "no_tab"): "count(*) FILTER (WHERE site_id % 4 = 0)",
        ("hotspots", "bad_json"): "count(*) FILTER (WHERE site_id % 4 = 1)",
        ("hotspots", "bad_coordinate"): "count(*) FILTER (WHERE site_id % 4 = 2)",
        ("hotspots", "missing_key"): "count(*) FILTER (WHERE site_id % 4 = 3)",
    }
    return _on_site(_union([f"SELECT '{s}' AS source, '{r}' AS reason, CAST({n} AS BIGINT) AS n FROM site" for (s, r), n in counts.items()]))


def _limits() -> str:
    fixed = "('cpu_percent', 70.0, 90.0), ('memory_percent', 70.0, 90.0), ('cpu_temp', 70.0, 85.0)"
    return f"""WITH {READINGS},
own AS (
  SELECT source, TIMESTAMP '2024-01-01' + to_days(CAST(step * 5 + source % 5 AS INTEGER)) AS since, (20 + 10 * step)::DOUBLE AS warning, (40 + 10 * step)::DOUBLE AS critical
  FROM (SELECT DISTINCT source FROM readings WHERE source % 3 = 0), range(4) AS s(step) WHERE step <= source % 4),
long AS (
  SELECT source, reading_id, ts, 'cpu_percent' AS metric, cpu_percent AS value FROM readings
  UNION ALL SELECT source, reading_id, ts, 'memory_percent', memory_percent FROM readings
  UNION ALL SELECT source, reading_id, ts, 'cpu_temp', cpu_temp FROM readings),
met AS (
  SELECT long.*, coalesce(own.warning, f.w::DOUBLE) AS warning, coalesce(own.critical, f.c::DOUBLE) AS critical
  FROM long JOIN (VALUES {fixed}) AS f(m, w, c) ON f.m = metric
    ASOF LEFT JOIN (SELECT *, 'cpu_percent' AS om FROM own) AS own ON own.source = long.source AND om = metric AND own.since <= ts)
SELECT source, reading_id, metric, warning, critical,
  CASE WHEN value < warning THEN 'good' WHEN value < critical THEN 'warning' WHEN value IS NOT NULL THEN 'critical' END AS status FROM met"""


def oracle_sql() -> dict[str, str]:
    points, latitudes = "count(*)", 'round(sum("Y"), 4)'
    kept = "count(*) FILTER (WHERE site_id % 7 <> 0)"
    kept_latitudes = 'round(sum("Y") FILTER (WHERE site_id % 7 <> 0), 4)'
    ordered = [c.replace('ORDER BY "X", "Y"', "ORDER BY site_id DESC") for c in _cells(0.5)]
    return {
        "sites_inferred_types": _inferred(),
        "inferred_columns_summary": _inferred_summary(),
        "hotspot_cells_input_order": _on_site(HOTSPOT_ROWS, *ordered),
        "severity_report_input_order": _on_site(_severity_rows("site_id DESC"), FEATURES, LIMITS, CLASSED),
        "largest_area_first_in_input": _on_site('SELECT "X", "Y", area, i_high FROM site ORDER BY area DESC, site_id DESC LIMIT 1'),
        "first_sites_in_input": _on_site('SELECT "X", "Y", i_mid, row_number() OVER (ORDER BY site_id DESC) - 1 AS line FROM site ORDER BY line LIMIT 20'),
        "numbered_sites": _on_site('SELECT "X", "Y", row_number() OVER (ORDER BY site_id DESC) - 1 AS line FROM site'),
        "batch_report_fields": _report_fields(),
        "report_missing_keys": _on_site(
            f"""SELECT 'whole' AS "case", {points} AS points, {latitudes} AS latitudes, NULL::VARCHAR AS error FROM site
UNION ALL SELECT 'skip', {kept}, {kept_latitudes}, NULL FROM site
UNION ALL VALUES ('empty', 0, NULL, NULL), ('raise', NULL, NULL, 'ValueError'), ('no file', 0, NULL, NULL), ('no file, raise', NULL, NULL, 'AnalysisException')"""
        ),
        "rejected_lines": _rejected(),
        "sketched_quantiles": _sketched(),
        "readings_keyed_state": f"WITH {READINGS}, {LATEST} SELECT source, reading_id FROM latest",
        "readings_limits": _limits(),
    }
