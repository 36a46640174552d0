"""DuckDB SQL that states, independently of Spark, what each registered query must return.

The common table expressions mirror the analog sources of ``plans.analog`` and the star
pipelines of ``plans.dims`` / ``plans.fact``; ``with_ctes`` pulls in the ones a query needs.
Floating sums are taken over values whose double sums are exact (counts, float32 prices) or
over DECIMAL, so both engines agree to the last bit.
"""

from __future__ import annotations

# (name, body, dependencies) in definition order
_CTES: list[tuple[str, str, tuple[str, ...]]] = [
    ("oc", """SELECT o.o_orderkey, o.o_custkey, o.o_orderstatus, o.o_totalprice, o.o_orderdate, o.o_orderpriority,
                     c.c_name, c.c_nationkey, c.c_mktsegment,
                     CASE WHEN o.o_orderpriority = '5-LOW' THEN 'OFFSHORE' ELSE c.c_mktsegment END AS state_place
              FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey""", ()),
    ("ocn", """SELECT oc.*, n.n_nationkey, n.n_name, n.n_regionkey,
                      CASE WHEN oc.o_orderstatus = 'P' THEN 'AT SEA' ELSE n.n_name END AS country_place
               FROM oc JOIN nation n ON oc.c_nationkey = n.n_nationkey""", ("oc",)),
    ("years", """SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS year FROM orders""", ()),
    ("country_labels", """SELECT CAST(n_nationkey AS INTEGER) AS country_code, lower(n_name) AS country_name
                          FROM nation""", ()),
    ("state_labels", """SELECT DISTINCT upper(substr(c_mktsegment, 1, 2)) AS state_code, lower(c_mktsegment) AS state_name
                        FROM customer""", ()),
    # countries, and beside them the orders of New Year's Day per region
    ("pss_cnt", """SELECT name, code, year, count(*) AS cnt FROM (
                     SELECT n_name AS name, CAST(n_nationkey AS VARCHAR) AS code,
                            CAST(year(o_orderdate) AS INTEGER) AS year FROM ocn
                     UNION ALL
                     SELECT r_name, 'R' || CAST(r_regionkey AS VARCHAR), CAST(year(o_orderdate) AS INTEGER)
                     FROM ocn JOIN region ON n_regionkey = r_regionkey
                     WHERE month(o_orderdate) = 1 AND day(o_orderdate) = 1) GROUP BY ALL""", ("ocn",)),
    # one row per name and year column: each name unpivoted over the list of year columns
    ("pss", """SELECT g.name AS country_name, g.code AS country_code, CAST(p.cnt AS REAL) AS pss, g.year
               FROM (SELECT name, code, unnest((SELECT list(year) FROM years)) AS year
                     FROM (SELECT DISTINCT name, code FROM pss_cnt)) g
               LEFT JOIN pss_cnt p ON p.name = g.name AND p.code = g.code AND p.year = g.year""", ("pss_cnt", "years")),
    # countries, and the world total of the last series
    ("un_cnt", """SELECT name, code, prio, year, count(*) AS cnt FROM (
                    SELECT n_name AS name, CAST(n_nationkey AS VARCHAR) AS code, o_orderpriority AS prio,
                           CAST(year(o_orderdate) AS INTEGER) AS year FROM ocn
                    UNION ALL
                    SELECT 'WORLD', 'WLD', o_orderpriority, CAST(year(o_orderdate) AS INTEGER) FROM ocn
                    WHERE o_orderpriority IN ('4-NOT SPECIFIED', '5-LOW')) GROUP BY ALL""", ("ocn",)),
    ("un", """SELECT g.name AS country_name, g.code AS country_code, g.year,
                     sum(CASE WHEN u.prio = '1-URGENT' THEN CAST(u.cnt AS REAL) END) AS uwae,
                     sum(CASE WHEN u.prio = '2-HIGH' THEN CAST(u.cnt AS REAL) END) AS uwbe,
                     sum(CASE WHEN u.prio = '3-MEDIUM' THEN CAST(u.cnt AS REAL) END) AS uwie,
                     sum(CASE WHEN u.prio IN ('4-NOT SPECIFIED', '5-LOW') THEN CAST(u.cnt AS REAL) END) AS ut
              FROM (SELECT name, code, unnest((SELECT list(year) FROM years)) AS year
                    FROM (SELECT DISTINCT name, code FROM un_cnt)) g
              LEFT JOIN un_cnt u ON u.name = g.name AND u.code = g.code AND u.year = g.year
              GROUP BY g.name, g.code, g.year""", ("un_cnt", "years")),
    ("pop_lines", """SELECT ocn.n_name, ocn.c_mktsegment, CAST(year(ocn.o_orderdate) AS INTEGER) AS year
                     FROM lineitem l JOIN ocn ON l.l_orderkey = ocn.o_orderkey""", ("ocn",)),
    # territories are delivered twice: repeated rows count in the yearly total and are removed after it
    ("pop_raw", """SELECT n_name AS country_name, year, CAST(count(*) AS INTEGER) AS count FROM pop_lines GROUP BY ALL
                   UNION ALL
                   SELECT 'TERRITORY ' || c_mktsegment, year, unnest([n, n]) FROM (
                     SELECT c_mktsegment, year, CAST(count(*) AS INTEGER) AS n FROM pop_lines GROUP BY ALL)""",
     ("pop_lines",)),
    ("pop", """SELECT DISTINCT country_name, year, count, powp FROM (
                 SELECT country_name, year, count,
                        count / nullif(sum(count) OVER (PARTITION BY year), 0) * 100 AS powp FROM pop_raw)""",
     ("pop_raw",)),
    ("keys", """SELECT country_name AS u_name, year AS u_year FROM pss
                UNION SELECT country_name, year FROM un
                UNION SELECT country_name, year FROM pop""", ("pss", "un", "pop")),
    ("ec_nl", """SELECT DISTINCT lower(k.u_name) AS country_name, k.u_year AS year, pss.pss, un.uwae, un.uwbe, un.uwie,
                        un.ut, pop.powp
                 FROM keys k
                 FULL JOIN pss ON k.u_name = pss.country_name AND k.u_year = pss.year
                 FULL JOIN un ON k.u_name = un.country_name AND k.u_year = un.year
                 FULL JOIN pop ON k.u_name = pop.country_name AND k.u_year = pop.year""", ("keys",)),
    ("ec", """SELECT n.country_name, n.year, n.pss, n.uwae, n.uwbe, n.uwie, n.ut, n.powp, l.country_code,
                     CAST(row_number() OVER (ORDER BY n.year NULLS FIRST, n.country_name NULLS FIRST, n.pss NULLS FIRST,
                          n.uwae NULLS FIRST, n.uwbe NULLS FIRST, n.uwie NULLS FIRST, n.ut NULLS FIRST,
                          n.powp NULLS FIRST, l.country_code NULLS FIRST) AS INTEGER) AS id_economics_country
              FROM ec_nl n LEFT JOIN country_labels l ON n.country_name = l.country_name
              WHERE l.country_code IS NOT NULL AND n.year IS NOT NULL""", ("ec_nl", "country_labels")),
    ("eus_nl", """SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
                         lower(state_place) AS state_name,
                         avg(CAST(CAST(o_totalprice AS VARCHAR) AS REAL)) AS ut
                  FROM oc GROUP BY year(o_orderdate), month(o_orderdate), state_place""", ("oc",)),
    ("eus", """SELECT n.year, n.month, n.state_name, n.ut, l.state_code,
                      CAST(row_number() OVER (ORDER BY n.year NULLS FIRST, n.state_name NULLS FIRST, n.month NULLS FIRST,
                           n.ut NULLS FIRST, l.state_code NULLS FIRST) AS INTEGER) AS id_economics_us_state
               FROM eus_nl n JOIN state_labels l ON n.state_name = l.state_name
               WHERE n.year IS NOT NULL AND n.month IS NOT NULL AND n.ut IS NOT NULL AND NOT isnan(n.ut)""",
     ("eus_nl", "state_labels")),
    ("tc_nl", """SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS year, lower(country_place) AS country_name,
                        CAST(month(o_orderdate) AS INTEGER) AS month,
                        avg(CAST(CAST(o_totalprice AS VARCHAR) AS REAL)) AS temperature,
                        min(CAST(CAST(o_totalprice AS VARCHAR) AS REAL)) AS min_temperature,
                        max(CAST(CAST(o_totalprice AS VARCHAR) AS REAL)) AS max_temperature
                 FROM ocn WHERE o_orderstatus <> 'F'
                 GROUP BY year(o_orderdate), country_place, month(o_orderdate)""", ("ocn",)),
    ("tc", """SELECT n.year, n.country_name, n.month, n.temperature, n.min_temperature, n.max_temperature, l.country_code,
                     CAST(row_number() OVER (ORDER BY n.year NULLS FIRST, n.country_name NULLS FIRST, n.month NULLS FIRST,
                          n.temperature NULLS FIRST, n.min_temperature NULLS FIRST, n.max_temperature NULLS FIRST,
                          l.country_code NULLS FIRST) AS INTEGER) AS id_temperature_country
              FROM tc_nl n JOIN country_labels l ON n.country_name = l.country_name
              WHERE n.year IS NOT NULL AND n.month IS NOT NULL AND n.temperature IS NOT NULL""",
     ("tc_nl", "country_labels")),
    ("tus_nl", """SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS year, lower(state_place) AS state_name,
                         CAST(month(o_orderdate) AS INTEGER) AS month,
                         avg(CAST(CAST(o_totalprice AS VARCHAR) AS REAL)) AS temperature,
                         min(CAST(CAST(o_totalprice AS VARCHAR) AS REAL)) AS min_temperature,
                         max(CAST(CAST(o_totalprice AS VARCHAR) AS REAL)) AS max_temperature
                  FROM oc WHERE o_orderstatus = 'F'
                  GROUP BY year(o_orderdate), state_place, month(o_orderdate)""", ("oc",)),
    ("tus", """SELECT n.year, n.state_name, n.month, n.temperature, n.min_temperature, n.max_temperature, l.state_code,
                      CAST(row_number() OVER (ORDER BY n.year NULLS FIRST, n.state_name NULLS FIRST, n.month NULLS FIRST,
                           n.temperature NULLS FIRST, n.min_temperature NULLS FIRST, n.max_temperature NULLS FIRST,
                           l.state_code NULLS FIRST) AS INTEGER) AS id_temperature_us_state
               FROM tus_nl n JOIN state_labels l ON n.state_name = l.state_name
               WHERE n.year IS NOT NULL AND n.month IS NOT NULL AND n.temperature IS NOT NULL""",
     ("tus_nl", "state_labels")),
    ("fact_src", """SELECT CAST(o_orderkey AS INTEGER) AS cicid, CAST(year(o_orderdate) AS INTEGER) AS i94yr,
                           CAST(month(o_orderdate) AS INTEGER) AS i94mon, c_nationkey AS i94cit,
                           CASE WHEN o_orderstatus = 'P' THEN CAST(99 AS INTEGER) ELSE c_nationkey END AS i94res,
                           o_orderstatus AS i94port,
                           CAST(datediff('day', DATE '1960-01-01', CAST(o_orderdate AS DATE)) AS INTEGER) AS arrdate,
                           CAST(o_orderkey % 3 + 1 AS INTEGER) AS i94mode, upper(substr(state_place, 1, 2)) AS i94addr,
                           CAST(datediff('day', DATE '1960-01-01', CAST(o_orderdate AS DATE)) + o_orderkey % 20 AS INTEGER)
                               AS depdate,
                           CAST(o_custkey % 80 AS INTEGER) AS i94bir,
                           CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS i94visa,
                           CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS dtadfile,
                           o_orderstatus AS entdepa, 'O' AS entdepd, 'M' AS matflag,
                           CAST(year(o_orderdate) - o_custkey % 80 AS INTEGER) AS biryear,
                           CASE WHEN o_orderstatus = 'P' THEN NULL
                                ELSE CAST(strftime(CAST(o_orderdate AS DATE) + INTERVAL 90 DAY, '%m%d%Y') AS INTEGER)
                           END AS dtaddto,
                           CASE WHEN o_orderkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
                           'A' || CAST(c_nationkey AS VARCHAR) AS airline,
                           CAST(trunc(o_totalprice * 1000) AS INTEGER) AS admnum,
                           CASE WHEN o_orderstatus = 'O' THEN NULL ELSE CAST(o_custkey AS INTEGER) END AS fltno,
                           'V' || substr(o_orderpriority, 1, 1) AS visatype
                    FROM oc""", ("oc",)),
    ("fact", """SELECT f.*, tus.id_temperature_us_state, tc.id_temperature_country, eus.id_economics_us_state,
                       ec.id_economics_country
                FROM fact_src f
                LEFT JOIN tus ON f.i94yr = tus.year AND f.i94mon = tus.month AND f.i94addr = tus.state_code
                LEFT JOIN tc ON f.i94yr = tc.year AND f.i94mon = tc.month AND f.i94res = tc.country_code
                LEFT JOIN eus ON f.i94yr = eus.year AND f.i94mon = eus.month AND f.i94addr = eus.state_code
                LEFT JOIN ec ON f.i94yr = ec.year AND f.i94res = ec.country_code""",
     ("fact_src", "tus", "tc", "eus", "ec")),
    ("nulled_orders", """SELECT o_orderkey,
                                CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_custkey END AS o_custkey,
                                CASE WHEN o_totalprice < 50000 THEN NULL ELSE o_orderstatus END AS o_orderstatus,
                                o_totalprice
                         FROM orders""", ()),
    ("sparse_orders", """SELECT o_orderkey,
                                CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_custkey END AS o_custkey,
                                o_orderstatus,
                                CASE WHEN o_orderpriority = '1-URGENT' THEN o_orderpriority END AS urgent_flag,
                                'X' AS source_tag
                         FROM orders""", ()),
]
_BY_NAME = {n: (b, d) for n, b, d in _CTES}
_ORDER = {n: i for i, (n, _, _) in enumerate(_CTES)}


def with_ctes(names, final: str) -> str:
    """``WITH`` the named CTEs and everything they depend on, then ``final``."""
    need: set[str] = set()
    stack = list(names)
    while stack:
        n = stack.pop()
        if n in need:
            continue
        need.add(n)
        stack.extend(_BY_NAME[n][1])
    parts = [f"{n} AS ({_BY_NAME[n][0]})" for n in sorted(need, key=_ORDER.get)]
    return "WITH " + ",\n".join(parts) + "\n" + final
