"""The same results in plain SQL over the base tables, for DuckDB."""

from __future__ import annotations

from scenlens.workload.queries import (
    ECO_CODES,
    ECO_FACTORS,
    ECO_NAMES,
    ECO_RINGS,
    DETAILED_RINGS,
    POINT_RINGS,
    edge_rows,
)

VIEWS = {
    "nations": """
        SELECT n_nationkey, n_name AS region, r_name AS super_region, r_regionkey AS super_key
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "years": "SELECT * FROM (VALUES (1995),(1996),(1997),(1998),(1999),(2000),(2001)) AS y(year)",
    "deciles": "SELECT * FROM (VALUES (1),(2),(3),(4),(5),(6),(7),(8),(9),(10)) AS d(decile)",
    "spine": """
        SELECT c.scenario, n.region, n.super_region, y.year
        FROM (SELECT DISTINCT c_mktsegment AS scenario FROM customer) c, nations n, years y""",
    "obs": """
        SELECT o_orderkey, o_custkey, c_mktsegment AS scenario, region, super_region, super_key,
               CAST(year(o_orderdate) AS INT) AS year, CAST(o_custkey % 10 + 1 AS INT) AS decile,
               o_orderpriority AS title, o_totalprice AS value
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nations ON c_nationkey = n_nationkey""",
    "pop": """
        SELECT s.scenario, s.region, s.super_region, s.year,
               CAST((1 + coalesce(k.n, 0)) * (1 + 0.01 * (s.year - 1995)) AS DOUBLE) AS value
        FROM spine s LEFT JOIN (
            SELECT c_mktsegment AS scenario, n_name AS region, count(*) AS n
            FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2) k
        ON s.scenario = k.scenario AND s.region = k.region""",
    "gdp": """
        SELECT s.scenario, s.region, s.year, coalesce(g.v, 1.0) AS value
        FROM spine s LEFT JOIN (
            SELECT scenario, region, year, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / count(*) / 1000 AS v FROM obs GROUP BY 1, 2, 3) g
        ON s.scenario = g.scenario AND s.region = g.region AND s.year = g.year""",
    "income": """
        SELECT s.scenario, s.region, s.year, d.decile, coalesce(g.v, 1.0) AS value
        FROM spine s CROSS JOIN deciles d LEFT JOIN (
            SELECT scenario, region, year, decile, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / count(*) / 1000 AS v
            FROM obs GROUP BY 1, 2, 3, 4) g
        ON s.scenario = g.scenario AND s.region = g.region AND s.year = g.year
           AND d.decile = g.decile""",
    "service": """
        SELECT o.scenario, o.region, o.super_region, o.year, o.decile, p_type AS technology,
               l_returnflag AS flag, l_linestatus AS status, l_partkey, l_suppkey,
               l_quantity AS demand, l_extendedprice / l_quantity AS cost, l_discount AS discount
        FROM lineitem JOIN obs o ON l_orderkey = o.o_orderkey JOIN part ON l_partkey = p_partkey""",
    "household": """
        SELECT s.scenario, s.region, s.year, d.decile, coalesce(g.c, 1.0) AS cost,
               coalesce(g.d, 1.0) AS demand
        FROM spine s CROSS JOIN deciles d LEFT JOIN (
            SELECT scenario, region, year, decile, avg(cost) AS c, sum(demand) AS d
            FROM service GROUP BY 1, 2, 3, 4) g
        ON s.scenario = g.scenario AND s.region = g.region AND s.year = g.year
           AND d.decile = g.decile""",
    "water": """
        SELECT scenario, region AS basin, year,
               CASE WHEN status = 'O' THEN 'runoff' ELSE 'groundwater' END AS subresource,
               sum(demand) AS supply, sum(demand * (1 - discount)) AS withdrawal
        FROM service GROUP BY 1, 2, 3, 4""",
    "scarcity": """
        SELECT w.scenario, w.year, w.subresource AS resource,
               sum(w.withdrawal / nullif(w.supply, 0) * b.supply) / nullif(sum(b.supply), 0) AS index_sup,
               sum(w.withdrawal / nullif(w.supply, 0) * b.withdrawal)
                   / nullif(sum(b.withdrawal), 0) AS index_wd
        FROM water w JOIN water b ON w.scenario = b.scenario AND w.basin = b.basin
             AND w.subresource = b.subresource AND b.year = 1995
        GROUP BY 1, 2, 3""",
    "grid": """
        SELECT scenario, CASE WHEN year < 1999 THEN 2020 ELSE 2050 END AS year,
               CAST(l_partkey % 12 * 30 - 165 AS DOUBLE) AS lon,
               CAST(l_suppkey % 6 * 30 - 75 AS DOUBLE) AS lat,
               CASE technology WHEN 'SMALL' THEN 'forest' WHEN 'LARGE' THEN 'pasture'
                    WHEN 'MEDIUM' THEN 'corn_irrigated' WHEN 'STANDARD' THEN 'corn_rainfed'
                    WHEN 'ECONOMY' THEN 'otherarableland' ELSE 'water' END AS landclass,
               sum(demand) AS value
        FROM service GROUP BY 1, 2, 3, 4, 5""",
    "cells": """
        SELECT scenario, year, lon, lat,
               sum(CASE WHEN landclass = 'forest' THEN value END) AS forest,
               sum(CASE WHEN landclass = 'pasture' THEN value END) AS pasture,
               sum(CASE WHEN landclass = 'corn_irrigated' THEN value END) AS crop_irr,
               sum(CASE WHEN landclass IN ('corn_rainfed', 'otherarableland') THEN value END) AS crop_rfd
        FROM grid GROUP BY 1, 2, 3, 4 HAVING count(DISTINCT landclass) = 6""",
    "runs": """
        SELECT *, 'study_' || CASE scenario
                   WHEN 'AUTOMOBILE' THEN 'trn' || gt WHEN 'FURNITURE' THEN 'bld' || gt
                   WHEN 'HOUSEHOLD' THEN 'afolu' || gt WHEN 'MACHINERY' THEN 'ind' || gt
                   ELSE 'base' END || '_SSP' || (super_key + 1) AS run
        FROM (SELECT *, CAST((CASE WHEN super_key = 0 THEN o_custkey % 3 ELSE o_custkey % 4 END + 1) * 5
                             AS INT) AS gt FROM obs)""",
    "run_years": """
        SELECT run, super_key + 1 AS ssp, gt, scenario = 'BUILDING' AS is_base, scenario, year,
               count(*) AS n, sum(value) AS total,
               sum(CASE WHEN decile <= 5 THEN value ELSE 0 END) AS half
        FROM (SELECT * REPLACE (CASE WHEN scenario = 'BUILDING' THEN 0 ELSE gt END AS gt) FROM runs)
        GROUP BY 1, 2, 3, 4, 5, 6""",
}

_USES = {
    "spine": ("nations", "years"),
    "obs": ("nations",),
    "pop": ("spine",),
    "gdp": ("spine", "obs"),
    "income": ("spine", "deciles", "obs"),
    "service": ("obs",),
    "household": ("spine", "deciles", "service"),
    "water": ("service",),
    "scarcity": ("water",),
    "grid": ("service",),
    "cells": ("grid",),
    "runs": ("obs",),
    "run_years": ("runs",),
}


def _with(uses: str, sql: str) -> str:
    needed: list[str] = []

    def add(name: str) -> None:
        for dep in _USES.get(name, ()):
            add(dep)
        if name not in needed:
            needed.append(name)

    for name in uses.split():
        add(name)
    ctes = ",\n".join(f"{n} AS ({VIEWS[n]})" for n in needed)
    body = sql.strip()
    return f"WITH {ctes},\n{body[5:]}" if body.startswith("WITH ") else f"WITH {ctes}\n{body}"


def r(expr: str, digits: int, name: str) -> str:
    """A rounded double; adding zero turns a negative zero into zero."""
    return f"round(CAST({expr} AS DOUBLE), {digits}) + CAST(0 AS DOUBLE) AS {name}"


def _values(rows) -> str:
    def one(v) -> str:
        return f"'{v}'" if isinstance(v, str) else f"CAST({v} AS DOUBLE)" if isinstance(v, float) else str(v)

    return ", ".join("(" + ", ".join(one(v) for v in row) + ")" for row in rows)


def _inside(points: str, ids: str, rings) -> str:
    """(ids, poly_id) of points in or on polygons, ray by ray against every edge."""
    return f"""
        SELECT {ids}, poly_id FROM (
            SELECT {ids}, poly_id,
                   sum(CASE WHEN (y1 > y) <> (y2 > y)
                            AND x > x1 + (y - y1) * (x2 - x1) / (y2 - y1) THEN 1 ELSE 0 END) % 2 = 1 AS odd,
                   bool_or((y - y1) * (x2 - x1) = (x - x1) * (y2 - y1)
                           AND x BETWEEN least(x1, x2) AND greatest(x1, x2)
                           AND y BETWEEN least(y1, y2) AND greatest(y1, y2)) AS touches
            FROM ({points}) p, (VALUES {_values(edge_rows(rings))}) AS e(poly_id, x1, y1, x2, y2)
            GROUP BY ALL) WHERE odd OR touches"""


TYPE_GROUP = "CASE WHEN technology IN ('SMALL','MEDIUM','ECONOMY') THEN 'light' WHEN technology IN ('LARGE','STANDARD') THEN 'heavy' ELSE technology END"
SEGMENT_SECTOR = "CASE scenario WHEN 'AUTOMOBILE' THEN 'trn' WHEN 'FURNITURE' THEN 'bld' WHEN 'HOUSEHOLD' THEN 'afolu' ELSE 'ind' END"
SECTORS = ("afolu", "bld", "dac", "ind", "sup", "trn")

INCOME = """
    SELECT region, decile, year,
           CASE WHEN region = 'NATION_3' THEN value * 1000 / 20 ELSE value * 1000 END AS income
    FROM income WHERE scenario = 'BUILDING' AND year <= 2001"""

ENERGY = f"""
    SELECT h.scenario, h.region, h.decile, h.year,
           100 * (1 + n.n_nationkey / 10.0)
             * (h.demand * (h.cost / 1e9) * 2.0 * 1e9)
             / (p.value * 100) / i.income AS energy_expenditure_per
    FROM household h JOIN pop p ON h.scenario = p.scenario AND h.region = p.region AND h.year = p.year
    JOIN nations n ON h.region = n.region
    JOIN ({INCOME}) i ON h.region = i.region AND h.decile = i.decile AND h.year = i.year"""

# Both inputs have the same price and demand but for staples, where each is halved: 1 + 1/4 of the product.
FOOD_EXP = """
    SELECT h.scenario, h.region, h.decile, h.year,
           1.25 * h.cost * h.demand * 0.5 * 365.25 / 0.5575288 / (p.value * 100) AS food_expenditure
    FROM household h JOIN pop p ON h.scenario = p.scenario AND h.region = p.region AND h.year = p.year"""
FOOD = f"""
    SELECT f.scenario, f.region, f.decile, f.year,
           f.food_expenditure * m.factor AS food_expenditure_mult,
           100 * f.food_expenditure * m.factor / (i.income / 0.5575288) AS food_expenditure_per
    FROM ({FOOD_EXP}) f
    JOIN (SELECT f.scenario, f.region, (max(n.n_nationkey) + 100) / avg(f.food_expenditure) AS factor
          FROM ({FOOD_EXP}) f JOIN nations n ON f.region = n.region
          WHERE f.year = 1998 GROUP BY 1, 2) m ON f.scenario = m.scenario AND f.region = m.region
    JOIN ({INCOME}) i ON f.region = i.region AND f.decile = i.decile AND f.year = i.year"""

BASKET = """
    SELECT e.region, e.scenario, e.year, sum(e.consumption * c.price) AS expenditure
    FROM (SELECT s.region, s.scenario, s.year,
                 CASE WHEN technology IN ('SMALL','MEDIUM','LARGE') THEN 'st' ELSE 'non' END AS sector,
                 sum(demand / 1e9) * 1e12 / (max(p.value) * 1000 * 365) AS consumption
          FROM service s JOIN pop p ON s.scenario = p.scenario AND s.region = p.region AND s.year = p.year
          GROUP BY 1, 2, 3, 4) e
    JOIN (SELECT region, scenario, year, sum(value) / 1000 AS price FROM income GROUP BY 1, 2, 3) c
    ON e.region = c.region AND e.scenario = c.scenario AND e.year = c.year
    GROUP BY 1, 2, 3"""

SHARES = """
    SELECT macro_region, country, year, value / sum(value) OVER (PARTITION BY macro_region, year) AS share
    FROM (SELECT CASE WHEN super_region = 'MIDDLE EAST' THEN 'EUROPE' ELSE super_region END AS macro_region,
                 region AS country, year, value FROM pop WHERE scenario = 'BUILDING')
    UNION ALL SELECT 'AFRICA', 'AFRICA', year, 1.0 FROM years"""

CELL_MAP = _inside("SELECT DISTINCT lon, lat, lon AS x, lat AS y FROM grid", "lon, lat", ECO_RINGS)
_CLASSES = ("forest", "pasture", "crop_irr", "crop_rfd")
AREAS = f"""
    SELECT s.scenario, c.code AS ECOREGION_CODE, n.name AS ECO_NAME,
           {", ".join(f"coalesce(sum(g.{c}_{i}), 0) * 1000000 AS {c}_{i}" for i in (0, 1) for c in _CLASSES)}
    FROM (SELECT DISTINCT c_mktsegment AS scenario FROM customer) s
    CROSS JOIN (VALUES {_values(ECO_CODES)}) AS c(id, code)
    JOIN (VALUES {_values(ECO_NAMES)}) AS n(code, name) ON c.code = n.code
    LEFT JOIN (
        SELECT a.scenario, m.poly_id,
               {", ".join(f"{t}.{c} AS {c}_{i}" for i, t in ((0, "a"), (1, "b")) for c in _CLASSES)}
        FROM (SELECT * FROM cells WHERE year = 2020) a
        JOIN (SELECT * FROM cells WHERE year = 2050) b
          ON a.scenario = b.scenario AND a.lon = b.lon AND a.lat = b.lat
        JOIN ({CELL_MAP}) m ON a.lon = m.lon AND a.lat = m.lat) g
    ON g.scenario = s.scenario AND g.poly_id = c.id
    GROUP BY 1, 2, 3"""

_MEASURES = {
    "Economy": ("Thous$/pers", "total / n / 1000", True),
    "Poverty": ("perc_income", "total / n / 10000", False),
    "Hunger": ("perc_GDP", "100 * half / total", False),
    "Health": ("Mortalities", "n", False),
    "Water": ("Index", "half / n / 100000", False),
}


def _diffs(sdg: str) -> str:
    """(unit, sdg, gt, ssp, sector, diff) of one report block."""
    unit, expr, relative = _MEASURES[sdg]
    change = "(x.v - b.v) / b.v" if relative else "x.v - b.v"
    return f"""
        SELECT '{unit}' AS unit, '{sdg}' AS sdg, x.gt, x.ssp, x.sector, avg({change}) AS diff
        FROM (SELECT ssp, gt, year, {SEGMENT_SECTOR} AS sector, {expr} AS v
              FROM run_years WHERE NOT is_base) x
        JOIN (SELECT ssp, year, {expr} AS v FROM run_years WHERE is_base) b
          ON x.ssp = b.ssp AND x.year = b.year
        WHERE x.year BETWEEN 1997 AND 2001
        GROUP BY 3, 4, 5"""


_LEGACY = (
    ("Thous$/pers", "Economy", "total / n / 1000"),
    ("perc_GDP", "Poverty", "100 * half / total"),
    ("Mortalities", "Health", "n"),
    ("Index", "Water", "half / n / 100000"),
    ("%", "Land", "100 * half / total / 3"),
)


def _legacy(unit: str, sdg: str, expr: str) -> str:
    """(unit, sdg, gt, sector, diff) of one block of the older report, second family."""
    return f"""
        SELECT '{unit}' AS unit, '{sdg}' AS sdg, x.gt, x.sector, avg(x.v - b.v) AS diff
        FROM (SELECT gt, year, {SEGMENT_SECTOR} AS sector, {expr} AS v FROM run_years
              WHERE ssp = 2 AND NOT is_base) x
        JOIN (SELECT year, {expr} AS v FROM run_years WHERE ssp = 2 AND is_base) b ON x.year = b.year
        WHERE x.year BETWEEN 1997 AND 2001 GROUP BY 3, 4"""


PSL_DIFFS = f"""
    SELECT 'PSL' AS unit, 'PSL' AS sdg, x.gt, x.ssp, x.sector, x.v - b.v AS diff
    FROM (SELECT ssp, gt, {SEGMENT_SECTOR} AS sector, sum(total) / 1e6 AS v
          FROM run_years WHERE NOT is_base GROUP BY 1, 2, 3) x
    JOIN (SELECT ssp, sum(total) / 1e6 AS v FROM run_years WHERE is_base GROUP BY 1) b ON x.ssp = b.ssp"""


def _wide(sectors, digits: int) -> str:
    return ",\n".join(
        r(f"max(CASE WHEN sector = '{s}' AND ssp = {k} THEN diff END)", digits, f"{s}_ssp{k}")
        for s in sectors
        for k in range(1, 6)
    )


LAND_LEAF = """
    SELECT scenario, region, l_suppkey % 6 AS basin, year, demand,
           CASE WHEN technology IN ('SMALL', 'MEDIUM') THEN 'Forest' WHEN technology = 'LARGE' THEN 'Pasture'
                WHEN technology = 'PROMO' THEN 'Urban'
                ELSE CASE technology WHEN 'STANDARD' THEN 'Corn' ELSE 'Wheat' END
                     || CASE flag WHEN 'A' THEN 'IRRhi' WHEN 'N' THEN 'RFDNA' ELSE '' END
           END AS landclass
    FROM service"""

_YEAR_SUM = ", ".join(
    r(f"sum(CASE WHEN year = {y} THEN demand END)", 4, f'"{y}"') for y in range(1996, 2002)
)

ORACLES = {
    "population": _with("pop", f"SELECT scenario, region, super_region, CAST(year AS INT) AS year, {r('value', 6, 'value')} FROM pop"),
    "gdp_per_capita": _with("gdp", f"SELECT scenario, region, CAST(year AS INT) AS year, CAST(value AS DOUBLE) AS value FROM gdp"),
    "population_weights": _with("pop", f"""
        SELECT scenario, region, CAST(year AS INT) AS year,
               {r('value / sum(value) OVER (PARTITION BY scenario, year)', 8, 'wpop')} FROM pop"""),
    "gdp_per_capita_world": _with("gdp pop", f"""
        SELECT g.scenario, CAST(g.year AS INT) AS year,
               {r('sum(g.value * p.value) / sum(p.value)', 6, 'GDPpc_thous')}
        FROM gdp g JOIN pop p ON g.scenario = p.scenario AND g.region = p.region AND g.year = p.year
        GROUP BY 1, 2"""),
    "label_rewrite": _with("service", f"""
        SELECT {TYPE_GROUP} AS technology, {r('sum(demand)', 4, 'demand')} FROM service GROUP BY 1"""),
    "label_rewrite_table": _with("obs", f"""
        SELECT CASE WHEN super_key <> 0 THEN super_region ELSE region END AS region,
               {r('sum(value)', 4, 'value')} FROM obs GROUP BY 1"""),
    "member_filter_emissions": _with("service", f"""
        SELECT scenario, {TYPE_GROUP} AS GHG, year, {r('sum(demand)', 4, 'demand')} FROM service
        WHERE technology IN ('SMALL','LARGE','PROMO','MEDIUM') AND scenario IN ('BUILDING','MACHINERY')
        GROUP BY 1, 2, 3"""),
    "catalog_predicate": _with("service", f"""
        SELECT scenario, region || '_water withdrawals' AS resource, 'runoff' AS subresource, year,
               {r('sum(demand)', 4, 'demand')} FROM service WHERE status = 'O' GROUP BY 1, 2, 4"""),
    "query_coverage": _with("obs", """
        SELECT title || '/' || region || '/' || year || '/' || decile AS title,
               count(DISTINCT scenario) AS n_scenarios,
               count(DISTINCT scenario) = (SELECT count(DISTINCT scenario) FROM obs) AS in_all_scenarios
        FROM obs GROUP BY 1"""),
    "missing_titles": _with("obs", """
        SELECT title || '/' || region || '/' || year || '/' || decile AS title FROM obs GROUP BY 1
        HAVING count(DISTINCT scenario) < (SELECT count(DISTINCT scenario) FROM obs)"""),
    "list_scenarios": _with("runs", "SELECT DISTINCT run AS scenario FROM runs"),
    "check_scenarios": _with("obs", f"""
        SELECT scenario, {r('sum(value)', 4, 'value')} FROM obs
        WHERE scenario IN ('BUILDING', 'FURNITURE') GROUP BY 1"""),
    "merge_projects_keep_first": _with("obs", f"""
        WITH split AS (SELECT *, decile <= 5 AND NOT (title = '1-URGENT' AND scenario = 'BUILDING') AS f FROM obs),
        a AS (SELECT title, scenario, sum(value) AS value, 'first' AS project FROM split WHERE f GROUP BY 1, 2),
        b AS (SELECT title, scenario, sum(value) AS value, 'second' AS project FROM split WHERE NOT f GROUP BY 1, 2)
        SELECT title, scenario, {r('value', 4, 'value')}, project FROM (
            SELECT * FROM a UNION ALL
            SELECT * FROM b WHERE (title, scenario) NOT IN (SELECT title, scenario FROM a))"""),
    "complete_years": _with("obs", f"""
        WITH cells AS (SELECT scenario, region, title, year, sum(value) AS demand FROM obs GROUP BY 1, 2, 3, 4),
        wanted AS (SELECT scenario, region, title, y.year
                   FROM (SELECT DISTINCT scenario, region, title FROM cells),
                        (VALUES (1994),(1995),(1996),(1997),(1998),(1999),(2005)) AS y(year))
        SELECT scenario, region, title, CAST(year AS INT) AS year, {r('coalesce(demand, 0)', 4, 'demand')}
        FROM wanted FULL JOIN cells USING (scenario, region, title, year)"""),
    "strict_join": _with("obs", f"""
        SELECT n_nationkey, year, {r('sum(value)', 4, 'value')}
        FROM obs JOIN nation ON region = n_name GROUP BY 1, 2"""),
    "natural_left_join_strict_sum": _with("service", f"""
        SELECT region, year, decile, flag,
               {r("CASE WHEN count(*) FILTER (technology = 'PROMO') = 0 THEN sum(demand * 5) END", 4, 'weighted')}
        FROM service GROUP BY 1, 2, 3, 4"""),
    "share_of_group": _with("obs", f"""
        SELECT scenario, region, year, {r('v / sum(v) OVER (PARTITION BY scenario, year)', 8, 'share')}
        FROM (SELECT scenario, region, year, sum(value) AS v FROM obs GROUP BY 1, 2, 3)"""),
    "weighted_ratios": _with("service", f"""
        SELECT scenario, year, {r('sum(discount * demand) / sum(demand)', 8, 'by_demand')},
               {r('sum(discount * cost) / sum(cost)', 8, 'by_cost')} FROM service GROUP BY 1, 2"""),
    "calibrated": _with("gdp nations", f"""
        SELECT g.scenario, g.region, CAST(g.year AS INT) AS year,
               {r('(100 + n_nationkey) / m.value', 9, 'factor')},
               {r('(100 + n_nationkey) / m.value * g.value', 9, 'scaled')}
        FROM gdp g JOIN gdp m ON g.scenario = m.scenario AND g.region = m.region AND m.year = 1998
        JOIN nations n ON g.region = n.region"""),
    "region_fold": _with("obs", f"""
        SELECT scenario, CASE region WHEN 'NATION_1' THEN 'NATION_0' ELSE region END AS region, year,
               {r('sum(value)', 4, 'value')} FROM obs GROUP BY 1, 2, 3"""),
    "member_duplicate": _with("pop", f"""
        SELECT scenario, region, super_region, CAST(year AS INT) AS year, {r('value', 4, 'value')} FROM (
            SELECT scenario, region, super_region, year, value FROM pop UNION ALL
            SELECT scenario, 'NATION_X', 'COPY', year, 1.0 FROM pop WHERE region = 'NATION_0')"""),
    "wide_by_year": _with("obs", f"""
        SELECT scenario, region, {", ".join(r(f"sum(CASE WHEN year = {y} THEN value END)", 4, f'"{y}"') for y in range(1995, 2002))}
        FROM obs GROUP BY 1, 2"""),
    "wide_to_long": _with("gdp", f"SELECT scenario, region, CAST(year AS INT) AS year, CAST(value AS DOUBLE) AS value FROM gdp"),
    "two_periods": _with("obs", f"""
        SELECT scenario, region, title, {r("sum(CASE WHEN year = 1995 THEN value END)", 4, "value_0")},
               {r("sum(CASE WHEN year = 2001 THEN value END)", 4, "value_1")}
        FROM obs WHERE year IN (1995, 2001) GROUP BY 1, 2, 3 HAVING count(DISTINCT year) = 2"""),
    "zero_filled_full_join": _with("spine obs", f"""
        SELECT s.scenario, s.region, CAST(s.year AS INT) AS year, CAST(d.decile AS INT) AS decile,
               {r('coalesce(sum(o.value), 0)', 4, 'value')}
        FROM (SELECT DISTINCT scenario, region, year FROM spine) s CROSS JOIN (SELECT unnest(range(1, 11)) AS decile) d
        LEFT JOIN obs o ON s.scenario = o.scenario AND s.region = o.region AND s.year = o.year AND d.decile = o.decile
        GROUP BY 1, 2, 3, 4"""),
    "numeric_sums": _with("service", f"""
        SELECT technology, {r('sum(demand)', 4, 'demand')}, {r('sum(discount)', 4, 'discount')}
        FROM service WHERE technology LIKE 'S%' GROUP BY 1"""),
    "means": _with("service", f"""
        SELECT scenario, year, {r('avg(cost)', 8, 'cost')}, {r('avg(discount)', 8, 'discount')}
        FROM service GROUP BY 1, 2"""),
    "scenario_parse": _with("obs", """
        SELECT DISTINCT 'study_' || w || decile || '_' || super_region AS scenario,
               'study_' || w || decile AS adj, decile AS gt,
               CASE decile WHEN 7 THEN 'a' WHEN 8 THEN 'bld' WHEN 9 THEN 'sup' WHEN 10 THEN 'dac' ELSE w END AS sector,
               lower(super_region) AS ssp
        FROM (SELECT *, CASE decile WHEN 1 THEN 'afolu' WHEN 2 THEN 'ind' WHEN 3 THEN 'bld' WHEN 4 THEN 'trn'
                        WHEN 5 THEN 'dac' WHEN 6 THEN 'sup' WHEN 7 THEN 'all' WHEN 8 THEN 'indbld'
                        WHEN 9 THEN 'afolusup' ELSE 'dactrn' END AS w FROM obs)"""),
    "income_by_decile": _with("income", f"""
        SELECT region, CAST(decile AS DOUBLE) AS decile, CAST(year AS INT) AS year, income
        FROM ({INCOME})"""),
    "energy_share": _with("household pop nations income", f"""
        SELECT scenario, region, CAST(decile AS DOUBLE) AS decile, CAST(year AS INT) AS year,
               {r('energy_expenditure_per', 6, 'energy_expenditure_per')} FROM ({ENERGY})"""),
    "food_share_calibrated": _with("household pop nations income", f"""
        SELECT scenario, region, CAST(decile AS DOUBLE) AS decile, CAST(year AS INT) AS year,
               {r('food_expenditure_mult', 5, 'food_expenditure_mult')},
               {r('food_expenditure_per', 5, 'food_expenditure_per')} FROM ({FOOD})"""),
    "basic_needs_world": _with("household pop nations income", f"""
        SELECT f.scenario, CAST(f.year AS INT) AS year,
               {r('sum((f.food_expenditure_per + e.energy_expenditure_per) * p.w * 0.1)', 6, 'total_expenditure_per_world')}
        FROM ({FOOD}) f JOIN ({ENERGY}) e ON f.scenario = e.scenario AND f.region = e.region
             AND f.decile = e.decile AND f.year = e.year
        JOIN (SELECT scenario, region, year, value / sum(value) OVER (PARTITION BY scenario, year) AS w FROM pop) p
          ON f.scenario = p.scenario AND f.region = p.region AND f.year = p.year
        GROUP BY 1, 2"""),
    "food_basket_regional": _with("service pop income", f"""
        SELECT region, scenario, CAST(year AS INT) AS year, {r('expenditure', 4, 'expenditure')} FROM ({BASKET})"""),
    "food_basket_pct_gdp": _with("service pop income gdp", f"""
        SELECT b.region, CAST(b.year AS INT) AS year, b.scenario,
               {r('100 * b.expenditure / (g.value * 1000 / 365 * 1.25)', 4, 'expenditure_percent_GDP')},
               'percentage' AS units
        FROM ({BASKET}) b JOIN gdp g ON b.scenario = g.scenario AND b.region = g.region AND b.year = g.year"""),
    "food_basket_pct_gdp_world": _with("service pop income gdp", f"""
        SELECT CAST(b.year AS INT) AS year, b.scenario, 'percentage' AS units,
               {r('sum(100 * b.expenditure / (g.value * 1000 / 365 * 1.25) * p.w)', 4, 'expenditure_percent_GDP')}
        FROM ({BASKET}) b JOIN gdp g ON b.scenario = g.scenario AND b.region = g.region AND b.year = g.year
        JOIN (SELECT scenario, region, year, value / sum(value) OVER (PARTITION BY scenario, year) AS w FROM pop) p
          ON b.scenario = p.scenario AND b.region = p.region AND b.year = p.year
        GROUP BY 1, 2"""),
    "food_basket_pct_gdp_published": _with("service pop income gdp", f"""
        SELECT CAST(b.year AS INT) AS year, b.scenario, 'percentage' AS units,
               {r('sum(100 * b.expenditure / 1.25 * p.w)', 3, 'expenditure_percent_GDP')}
        FROM ({BASKET}) b
        JOIN (SELECT scenario, region, year, value / sum(value) OVER (PARTITION BY scenario, year) AS w FROM pop) p
          ON b.scenario = p.scenario AND b.region = p.region AND b.year = p.year
        GROUP BY 1, 2"""),
    "paf_mortality": _with("obs", f"""
        SELECT k.scenario, k.region, k.year, k.decile AS age, k.title AS disease,
               {r('m.rate * (k.n / 10.0) / (1 + k.n / 10.0) * e.n', 10, 'mort')}
        FROM (SELECT scenario, region, year, title, decile, count(*) AS n FROM obs GROUP BY ALL) k
        JOIN (SELECT region, year, title, decile, avg(value) / 1000003 AS rate FROM obs GROUP BY ALL) m
          ON k.region = m.region AND k.year = m.year AND k.title = m.title AND k.decile = m.decile
        JOIN (SELECT scenario, region, year, decile, count(*) AS n FROM obs GROUP BY ALL) e
          ON k.scenario = e.scenario AND k.region = e.region AND k.year = e.year AND k.decile = e.decile"""),
    "country_share": _with("pop years", f"""
        SELECT macro_region, country, CAST(year AS INT) AS year, {r('share', 8, 'share')} FROM ({SHARES})"""),
    "mortality_downscaled": _with("obs pop years", f"""
        WITH dead AS (SELECT scenario, CASE super_region WHEN 'MIDDLE EAST' THEN 'EUROPE' ELSE super_region END AS region,
                             year, sum(value / 1000) AS pm, sum(value / 3000) AS o3 FROM obs GROUP BY ALL)
        SELECT d.scenario, 'M' || coalesce(CAST(n_nationkey % 7 AS VARCHAR), '7') AS model_region,
               CAST(d.year AS INT) AS year,
               {r('sum(round_even(d.pm * s.share, 0)) + sum(round_even(d.o3 * s.share, 0))', 2, 'mort')}
        FROM ({SHARES}) s JOIN dead d ON s.macro_region = d.region AND s.year = d.year
        LEFT JOIN nation ON s.country = n_name GROUP BY 1, 2, 3"""),
    "water_supply": _with("water", f"""
        SELECT scenario, basin, subresource, 'km^3' AS Units, year, {r('supply', 4, 'value_sup')} FROM water"""),
    "water_withdrawal": _with("water", f"""
        SELECT scenario, basin, subresource, 'km^3' AS Units, year, {r('withdrawal', 4, 'value_wd')} FROM water"""),
    "water_scarcity_index": _with("scarcity", f"""
        SELECT scenario, year, resource, {r('index_sup', 8, 'index_sup')}, {r('index_wd', 8, 'index_wd')} FROM scarcity"""),
    "water_scarcity_runoff": _with("scarcity", f"""
        SELECT scenario, year, resource, {r('index_wd', 8, 'index_wd')} FROM scarcity WHERE resource = 'runoff'"""),
    "land_projection_wide": _with("service", f"""
        SELECT region, landclass, CAST(basin + 1 AS INT) AS metric_id, scenario, {_YEAR_SUM}
        FROM ({LAND_LEAF}) WHERE basin < 5 GROUP BY 1, 2, 3, 4"""),
    "grid_pivot_classes": _with("cells", f"""
        SELECT scenario, CAST(year AS INT) AS year, lon, lat, {", ".join(r(c, 4, c) for c in _CLASSES)} FROM cells"""),
    "grid_pivot_all": _with("grid", f"""
        SELECT scenario, CAST(year AS INT) AS year, lon, lat,
               {", ".join(r(f"sum(CASE WHEN landclass = '{c}' THEN value END)", 4, c) for c in ("forest", "pasture", "corn_irrigated", "corn_rainfed", "otherarableland", "water"))}
        FROM grid GROUP BY 1, 2, 3, 4 HAVING count(DISTINCT landclass) = 6"""),
    "cell_map": _with("grid", f"SELECT lon, lat, CAST(poly_id AS INT) AS OBJECTID FROM ({CELL_MAP})"),
    "ecoregion_areas": _with("cells", f"""
        SELECT scenario, ECOREGION_CODE, ECO_NAME,
               {", ".join(r(f"{c}_{i}", 0, f"{c}_{i}") for i in (0, 1) for c in _CLASSES)},
               {", ".join(r(f"{c}_1 - {c}_0", 0, f"{c}_diff") for c in _CLASSES)}
        FROM ({AREAS})"""),
    "species_loss": _with("cells", f"""
        SELECT scenario,
               {", ".join(r(f"sum(({c}_1 - {c}_0) * f.{c})", 4, f"{c}_PSL") for c in _CLASSES)},
               {r("sum(" + " + ".join(f"({c}_1 - {c}_0) * f.{c}" for c in _CLASSES) + ")", 4, "final_PSL")}
        FROM ({AREAS}) a JOIN (VALUES {_values(ECO_FACTORS)}) AS f(code, forest, pasture, crop_irr, crop_rfd)
          ON a.ECOREGION_CODE = f.code
        GROUP BY 1"""),
    "points_in_detailed_polygons": f"""
        SELECT vec_id, CAST(poly_id AS INT) AS poly_id FROM ({_inside(
            "SELECT vec_id, CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y FROM embeddings",
            "vec_id", DETAILED_RINGS)})""",
    "points_in_polygons": f"""
        SELECT vec_id, CAST(poly_id AS INT) AS poly_id FROM ({_inside(
            "SELECT vec_id, CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y FROM embeddings",
            "vec_id", POINT_RINGS)})""",
    "compare_relative": _with("run_years", f"""
        SELECT unit, sdg, CAST(gt AS DOUBLE) AS Gt_CO2_reduction, {_wide((*SECTORS, "a"), 8)}
        FROM ({_diffs("Economy")}) GROUP BY 1, 2, 3"""),
    "compare_absolute": _with("run_years", f"""
        SELECT unit, sdg, CAST(gt AS DOUBLE) AS Gt_CO2_reduction, {_wide((*SECTORS, "a"), 8)}
        FROM ({_diffs("Water")}) GROUP BY 1, 2, 3"""),
    "compare_water_scarcity": _with("scarcity", f"""
        SELECT 'Index' AS unit, 'Water' AS sdg,
               CAST(CASE WHEN x.scenario IN ('AUTOMOBILE', 'FURNITURE') THEN 10 ELSE 20 END AS DOUBLE) AS Gt_CO2_reduction,
               {", ".join(r(f"avg(x.index_wd - b.index_wd) FILTER ({SEGMENT_SECTOR.replace('scenario', 'x.scenario')} = '{s}')", 8, f"{s}_ssp2") for s in ("afolu", "bld", "ind", "trn"))}
        FROM scarcity x JOIN scarcity b ON x.year = b.year AND x.resource = b.resource AND b.scenario = 'BUILDING'
        WHERE x.resource = 'runoff' AND x.scenario <> 'BUILDING' AND x.year BETWEEN 1997 AND 2001
        GROUP BY 1, 2, 3"""),
    "compare_legacy": _with("run_years", f"""
        SELECT 'Thous$/pers' AS unit, 'Economy' AS sdg, CAST(x.gt AS VARCHAR) AS Gt_CO2_reduction,
               {", ".join(r(f"avg(x.v - b.v) FILTER (x.sector = '{s}')", 8, s) for s in ("afolu", "bld", "ind", "sup", "trn", "a"))}
        FROM (SELECT gt, year, {SEGMENT_SECTOR} AS sector, total / n / 1000 AS v FROM run_years WHERE ssp = 2 AND NOT is_base) x
        JOIN (SELECT year, total / n / 1000 AS v FROM run_years WHERE ssp = 2 AND is_base) b ON x.year = b.year
        WHERE x.year BETWEEN 1997 AND 2001 GROUP BY 1, 2, 3"""),
    "legacy_report": _with("run_years", f"""
        SELECT unit, sdg, CAST(gt AS VARCHAR) AS Gt_CO2_reduction,
               {", ".join(r(f"max(CASE WHEN sector = '{s}' THEN diff END)", 8, s) for s in ("afolu", "bld", "ind", "sup", "trn", "a", "dac"))}
        FROM ({" UNION ALL ".join(_legacy(*b) for b in _LEGACY)}) GROUP BY 1, 2, 3"""),
    "scalar_baseline": _with("run_years", f"""
        SELECT 'study_' || sector || gt || '_SSP' || ssp AS scenario, 'SSP3' AS family, unit, sdg,
               {r('diff', 6, 'diff')} FROM ({PSL_DIFFS}) WHERE ssp = 3"""),
    "deliverable_wide": _with("run_years", f"""
        SELECT CAST(gt AS DOUBLE) AS Gt_CO2_reduction, unit, sdg, {_wide(("afolu", "bld", "ind", "trn"), 8)}
        FROM ({" UNION ALL ".join(_diffs(s) for s in _MEASURES)} UNION ALL {PSL_DIFFS})
        GROUP BY 1, 2, 3 HAVING count(DISTINCT ssp) = 5"""),
    "gather_union": _with("run_years", f"""
        SELECT run AS scenario, year, 'percentage' AS units,
               {r('100 * half / total', 6, 'expenditure_percent_GDP')}
        FROM run_years WHERE ssp IN (2, 4) AND NOT is_base"""),
    "scan_text_files": _with("obs", f"""
        SELECT scenario, year, {r('sum(value)', 4, 'value')} FROM obs GROUP BY 1, 2"""),
    "gathered_tables": _with("run_years", f"""
        SELECT run AS scenario, year, CAST(2 AS BIGINT) AS copies,
               {r('100 * half / total', 4, 'expenditure_percent_GDP')} FROM run_years"""),
    "registered_title": _with("gdp", f"""
        SELECT scenario, region, 'thous$' AS Units, CAST(year AS INT) AS year, CAST(value AS DOUBLE) AS value
        FROM gdp WHERE scenario IN ('BUILDING', 'MACHINERY')"""),
}


def _exact(value: str) -> str:
    """The exact sum of doubles below 2^30 and of bits above 2^-70, as whole numbers; a text rounds correctly."""
    scale = f"{2.0**70!r}::DOUBLE"
    return f"CAST(CAST(sum(CAST(({value}) * {scale} AS HUGEINT)) AS VARCHAR) AS DOUBLE) / {scale}"


def _pick(*members: str) -> str:
    return "[" + ", ".join(f"'{m}'" for m in members) + f"][CAST(decile AS INT) % {len(members)} + 1]"


# Each title's row filter.
_FILTERS = {
    "sector IN ('FoodDemand_Staples', 'FoodDemand_NonStaples')": ["food consumption by type (specific)"],
    "consumer = 'FoodDemand'": ["food demand prices"],
    "regexp_matches(consumer, '^FoodDemand_Group([1-9]|10)$')": [
        "food demand prices by income group", "food demand by income group",
    ],
    "account = 'gdp-per-capita-ppp'": ["GDP per capita PPP by region"],
    "account = 'GDP'": ["GDP MER by region"],
    "sector_type = 'AgSupplySector'": [
        "ag production by crop type", "ag production by subsector (land use region)", "ag commodity prices",
    ],
    "subsector = 'International Aviation'": ["International Aviation emissions"],
    "subsector = 'International Ship'": ["International Shipping emissions"],
    "GHG NOT IN ('CO2', 'CO2_FUG')": ["nonCO2 emissions by resource production"],
    "GHG IN ('CH4', 'N2O')": ["nonCO2 emissions by sector (excluding resource production)"],
    "resource LIKE '%water withdrawals%' AND subresource LIKE '%runoff%'": [
        "Basin level available runoff", "Water Withdrawals by Basin (Runoff)",
    ],
    "resource LIKE '%water withdrawals%' AND subresource LIKE '%groundwater%'": [
        "Water Withdrawals by Basin (Groundwater)",
    ],
    "sector = 'building' OR final_energy = 'building'": [
        "building service costs", "building service output by service",
    ],
    "true": [
        "population by region", "prices of all markets", "resource supply curves", "detailed land allocation",
        "subregional population", "subregional income",
    ],
}
_PREDICATES = f"""
    SELECT scenario, {_pick('FoodDemand_Staples', 'FoodDemand_NonStaples', 'building', 'beef')} AS sector,
      {_pick('FoodDemand', 'FoodDemand_Group1', 'FoodDemand_Group5', 'x')} AS consumer,
      {_pick('gdp-per-capita-ppp', 'GDP', 'labor')} AS account, {_pick('AgSupplySector', 'energy')} AS sector_type,
      {_pick('International Aviation', 'International Ship', 'rail')} AS subsector,
      {_pick('CO2', 'CO2_FUG', 'CH4', 'N2O', 'none')} AS GHG, {_pick('a_water withdrawals', 'land')} AS resource,
      {_pick('runoff', 'groundwater', 'runoff groundwater')} AS subresource,
      {_pick('building', 'industry', 'transport')} AS final_energy
    FROM obs"""
_SEGMENTS = "['AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY']"

ORACLES["bucketed_energy_share"] = ORACLES["energy_share"]

ORACLES |= {
    "first_file_not_empty": ORACLES["scan_text_files"],
    "preamble_lookup": _with("nations", """
        SELECT region, CASE WHEN n_nationkey % 5 <> 0 THEN 1 + n_nationkey / 10.0 END::DOUBLE AS energy_mult,
               CAST(CASE WHEN n_nationkey % 7 <> 0 THEN 2005 END AS INT) AS year FROM nations"""),
    "lookup_csv": _with("nations", "SELECT super_region AS supplysector, region AS subsector FROM nations"),
    "scenario_folders": _with("gdp", f"""
        SELECT scenario, region, CAST(year AS INT) AS year, CAST(value AS DOUBLE) AS value FROM gdp"""),
    "prefixes_stripped": _with("obs", f"""
        SELECT scenario, CAST(year AS INT) AS year, {r('sum(value)', 4, 'value')} FROM obs GROUP BY 1, 2"""),
    "columns_by_predicate": _with("obs", "SELECT DISTINCT scenario, region, super_region FROM obs"),
    "income_of_all_scenarios": _with("income", f"""
        SELECT scenario, region, CAST(decile AS DOUBLE) AS decile, CAST(year AS INT) AS year,
               CAST(value * 1000 AS DOUBLE) AS income FROM income WHERE year <= 2001"""),
    "grid_to_rows": _with("gdp", f"""
        SELECT region, CAST(year AS INT) AS lon, CAST(list_position({_SEGMENTS}, scenario) AS INT) AS lat,
               CAST(value AS DOUBLE) AS value FROM gdp WHERE year NOT IN (1999, 2000)"""),
    "split_nests": _with("service", "SELECT DISTINCT technology, flag, technology AS nest FROM service"),
    "project_names": _with("nations", """
        SELECT region, 'database_basexdb_' || CASE WHEN n_nationkey % 2 = 0 THEN region || '_base'
               ELSE 'SSP2_' || region END AS project FROM nations"""),
    "catalog_predicates": _with("obs", f"""
        WITH p AS ({_PREDICATES}) """ + " UNION ALL ".join(
            f"SELECT scenario, count(*) AS n_rows, '{t}' AS title FROM p WHERE {test} GROUP BY 1"
            for test, titles in _FILTERS.items() for t in titles)),
    "gather_family": _with("run_years", f"""
        SELECT run AS scenario, CAST(year AS INT) AS year, 'percentage' AS units,
               {r('100 * half / total', 6, 'expenditure_percent_GDP')}
        FROM run_years WHERE ssp = 3 AND NOT is_base"""),
    "gather_reference": _with("run_years", f"""
        SELECT run AS scenario, CAST(year AS INT) AS year, 'percentage' AS units,
               {r('100 * half / total', 6, 'expenditure_percent_GDP')} FROM run_years WHERE is_base"""),
    "gather_psl": f"""
        SELECT scenario, CAST(2 AS BIGINT) AS copies, {r('final_PSL', 4, 'final_PSL')}
        FROM ({ORACLES['species_loss']})""",
    "report_end_to_end": ORACLES["deliverable_wide"],
    "report_without_health_and_land": f"""
        SELECT * FROM ({ORACLES['deliverable_wide']}) WHERE sdg NOT IN ('Health', 'PSL')""",
    "report_order": f"""
        SELECT sdg, Gt_CO2_reduction, row_number() OVER (ORDER BY sdg, Gt_CO2_reduction) - 1 AS place
        FROM ({ORACLES['deliverable_wide']})""",
    "level_order": _with("obs", """
        SELECT o_orderkey || '.50' AS Gt_CO2_reduction, row_number() OVER (ORDER BY o_orderkey) - 1 AS place
        FROM obs"""),
    "grid_tiles": _with("service", f"""
        SELECT scenario, -180 + 0.5 * (l_partkey % 97)::DOUBLE AS lon, 89.5 - 3 * (l_suppkey % 53)::DOUBLE AS lat,
               {r('sum(demand)', 4, 'value')} FROM service GROUP BY 1, 2, 3"""),
    "grid_tiles_within": _with("service", f"""
        SELECT scenario, -180 + 0.5 * (l_partkey % 97)::DOUBLE AS lon, 89.5 - 3 * (l_suppkey % 53)::DOUBLE AS lat,
               {r('sum(demand)', 4, 'value')} FROM service GROUP BY 1, 2, 3
        HAVING -171 <= lon AND lon <= -150 AND 50 <= lat AND lat <= 80"""),
    "exact_revenue": _with("service", f"""
        SELECT scenario, CAST(year AS INT) AS year, {_exact("cost * demand * (1 - discount)")} AS revenue,
               {_exact("discount")} AS discount, count(*) AS n FROM service GROUP BY 1, 2"""),
    "exact_mean_revenue": _with("service", f"""
        SELECT region, {_exact("cost * demand * (1 - discount)")} / count(*) AS revenue FROM service GROUP BY 1"""),
    "open_pivot": _with("service", """
        SELECT scenario, CAST(year AS INT) AS year, string_agg(member || '=' || n, ',' ORDER BY member) AS cells FROM (
          SELECT scenario, year, technology || '_' || flag AS member, count(*) AS n FROM service GROUP BY 1, 2, 3)
        GROUP BY 1, 2"""),
    "open_pivot_filled": _with("obs", """
        WITH large AS (SELECT scenario, region, title, count(*) AS n FROM obs WHERE value > 400000 GROUP BY 1, 2, 3)
        SELECT scenario, region,
          CASE WHEN '1-URGENT' IN (SELECT title FROM large) THEN coalesce(max(n) FILTER (title = '1-URGENT'), 0) END AS "1-URGENT",
          CASE WHEN '5-LOW' IN (SELECT title FROM large) THEN coalesce(max(n) FILTER (title = '5-LOW'), 0) END AS "5-LOW",
          CAST(NULL AS BIGINT) AS "no such",
          CAST((SELECT count(DISTINCT title) FROM large WHERE title NOT IN ('1-URGENT', '5-LOW')) AS INT) AS others
        FROM large GROUP BY 1, 2"""),
    "committed_runs": _with("run_years", f"""
        SELECT run AS scenario, CAST(year AS INT) AS year, 'percentage' AS units,
               {r('2 * (100 * half / total)', 6, 'expenditure_percent_GDP')}
        FROM run_years WHERE ssp IN (2, 4)"""),
    "customer_ranks": _with("obs", """
        WITH c AS (SELECT o_custkey, count(*) AS n_orders FROM obs GROUP BY 1)
        SELECT o_custkey, n_orders, rank() OVER (ORDER BY n_orders DESC) AS rank,
               dense_rank() OVER (ORDER BY n_orders DESC) AS dense_rank,
               row_number() OVER (ORDER BY n_orders DESC, o_custkey) - 1 AS place,
               CAST(coalesce(sum(n_orders) OVER (ORDER BY n_orders DESC, o_custkey
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS orders_before FROM c"""),
    "water_units_differ": _with("obs", f"""
        WITH c AS (SELECT scenario, region, year, sum(value) AS v FROM obs GROUP BY 1, 2, 3),
        w AS (SELECT scenario, region, v AS ws, v / 2 + 1 AS ww FROM c WHERE year = 1995)
        SELECT scenario, CAST(year AS INT) AS year, 'runoff' AS resource,
          CASE WHEN year <> 1995 AND year % 2 = 1 THEN {r('sum((v / 2 + 1) / v * ws) / sum(ws)', 6, 'x').rsplit(' AS ', 1)[0]} END AS index_sup,
          CASE WHEN year <> 1995 AND year % 2 = 1 THEN {r('sum((v / 2 + 1) / v * ww) / sum(ww)', 6, 'x').rsplit(' AS ', 1)[0]} END AS index_wd
        FROM c JOIN w USING (scenario, region) GROUP BY scenario, year"""),
}
