"""DuckDB text of the star schema over the driver tables (oracle side).

Stated from the definitions of SURVEY: all dimensions are read from one union
of the facts' keys, and the KPIs from sums and row counts per (date, site): a
row of either side of the published many-to-many join counts once for each row
it meets on the other side.
"""

from __future__ import annotations

from plantwise.sources.adapters import SQL_SILVER

_FACT_KEYS = """
fact_keys AS (
  SELECT date_key, site_code, NULL AS line_code, NULL AS product_code FROM fact_costs
  UNION ALL SELECT date_key, site_code, line_code, NULL FROM fact_energy
  UNION ALL SELECT date_key, site_code, line_code, product_code FROM fact_manufacturing),
dim_site AS (SELECT site_code FROM fact_keys GROUP BY ALL),
dim_line AS (SELECT site_code, line_code FROM fact_keys WHERE line_code IS NOT NULL GROUP BY ALL),
dim_product AS (SELECT product_code FROM fact_keys WHERE product_code IS NOT NULL GROUP BY ALL),
dim_date AS (
  SELECT date_key, date, CAST(year(date) AS INTEGER) AS y, CAST(month(date) AS INTEGER) AS m,
         CAST(day(date) AS INTEGER) AS d
  FROM (SELECT date_key, CAST(strptime(CAST(date_key AS VARCHAR), '%Y%m%d') AS DATE) AS date
        FROM fact_keys GROUP BY ALL))"""


def _sums(name: str, fact: str, value: str, more: str = "") -> str:
    return (f"{name} AS (SELECT date_key, site_code, SUM({value}) AS s, COUNT(*) AS n{more} "
            f"FROM {fact} GROUP BY date_key, site_code)")


def unit_kpi(name: str, left: str, ratio: str, dates: str = "dim_date") -> str:
    """A per-unit KPI from per-key sums: each left row meets every production
    row of its key (one empty partner if there is none)."""
    return f"""
{name} AS (
  SELECT l.date_key, c.y, c.m, l.site_code,
         CAST(l.s * greatest(coalesce(u.n, 0), 1) AS DOUBLE) / nullif(CAST(l.n * u.s AS DOUBLE), 0) AS {ratio}
  FROM {left} l JOIN {dates} c ON l.date_key = c.date_key
  LEFT JOIN units_by_key u ON u.date_key = l.date_key AND u.site_code = l.site_code)"""


def deviation(prefix: str, other: str, total: str, dates: str = "dim_date") -> str:
    """Monthly cost against a driver's total, and its relative distance from
    the share that the corpus-wide means give (``<prefix>dev``)."""
    return f"""
{prefix}month AS (
  SELECT c.y, c.m, l.site_code,
         CAST(SUM(l.s * greatest(coalesce(o.n, 0), 1)) AS DOUBLE) AS total_cost_brl,
         CAST(SUM(l.n * o.s) AS DOUBLE) AS {total}
  FROM cost_by_key l JOIN {dates} c ON l.date_key = c.date_key
  LEFT JOIN {other} o ON o.date_key = l.date_key AND o.site_code = l.site_code
  GROUP BY c.y, c.m, l.site_code),
{prefix}pos AS (SELECT * FROM {prefix}month WHERE {total} > 0),
{prefix}mean AS (SELECT AVG(total_cost_brl) AS cost, AVG({total}) AS driver FROM {prefix}pos),
{prefix}dev AS (
  SELECT p.*, abs(total_cost_brl - cost * ({total} / nullif(driver, 0))) / nullif(cost, 0) AS rel_diff
  FROM {prefix}pos p, {prefix}mean)"""


def star_ctes(energy: str = "lineitem") -> str:
    silver_energy = SQL_SILVER["silver_energy" if energy == "lineitem" else "silver_energy_events"]
    month_key = "CAST(strftime(ref_month, '%Y%m01') AS INTEGER)"
    day_key = "CAST(strftime({}, '%Y%m%d') AS INTEGER)".format
    return ",\n".join([
        f"silver_costs AS ({SQL_SILVER['silver_costs']})",
        f"silver_manufacturing AS ({SQL_SILVER['silver_manufacturing']})",
        f"silver_energy AS ({silver_energy})",
        f"fact_costs AS (SELECT {month_key} AS date_key, * EXCLUDE (ref_month) FROM silver_costs WHERE ref_month IS NOT NULL)",
        f"fact_manufacturing AS (SELECT {day_key('date')} AS date_key, * EXCLUDE (date) FROM silver_manufacturing)",
        f"""fact_energy AS (
  SELECT {day_key('timestamp')} AS date_key, site_code, line_code, equip_code, SUM(kwh) AS kwh_day,
         MAX(kw_demand) AS kw_demand_peak_day, SUM(kvarh) AS kvarh_day
  FROM silver_energy GROUP BY ALL)""",
        _FACT_KEYS.strip(),
        _sums("cost_by_key", "fact_costs", "amount_br",
              ", SUM(CAST(amount_br AS DOUBLE) - amount_fx * fx_rate) AS fx"),
        _sums("units_by_key", "fact_manufacturing", "units_ok"),
        _sums("energy_by_key", "fact_energy", "kwh_day"),
        unit_kpi("kpi_cost_per_unit", "cost_by_key", "cost_per_unit").strip(),
        unit_kpi("kpi_energy_per_unit", "energy_by_key", "kwh_per_unit").strip(),
        "kpi_fx_effect AS (SELECT date_key, site_code, fx / nullif(CAST(s AS DOUBLE), 0) AS fx_effect_ratio FROM cost_by_key)",
    ])


def with_star(body: str, energy: str = "lineitem", extra_ctes: str = "") -> str:
    extra = f",\n{extra_ctes}" if extra_ctes.strip() else ""
    return f"WITH {star_ctes(energy)}{extra}\n{body}"
