"""Building blocks of the independent SQL oracle (ANSI SQL as DuckDB runs it).

The oracle states each derivation a second time, in SQL, over the same parquet
tables; it shares no code path with the Spark operators."""

from __future__ import annotations


def R(x: str, d: int = 2) -> str:
    """Round half away from zero on the shortest decimal form of a double —
    the same rule as Spark's ``round`` on doubles."""
    return f"CAST(round(CAST(CAST(({x}) AS VARCHAR) AS DECIMAL(38,18)),{d}) AS DOUBLE)"


def AVG(x: str) -> str:
    """Exact money average: decimal sum / count, as double."""
    return f"(CAST(sum({x}) AS DOUBLE) / nullif(count({x}), 0))"


def PCT(num: str, den: str, d: int = 2) -> str:
    return R(f"CAST({num} AS DOUBLE) / nullif(CAST({den} AS DOUBLE), 0) * 100", d)


def GROWTH(cur: str, prev: str, d: int = 2) -> str:
    return PCT(f"({cur}) - ({prev})", prev, d)


PANEL = """panel AS (
  SELECT entity, dt, value, CASE WHEN weekofyear(dt) IN (6,36,47,52) THEN 1 ELSE 0 END AS flag,
         cov_a, cov_b, cov_c, cov_d
  FROM (SELECT l_suppkey AS entity,
               CAST(date_trunc('week', CAST(l_shipdate AS DATE)) AS DATE) AS dt,
               CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS value,
               CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE)/count(*) AS cov_a,
               CAST(sum(CAST(l_discount AS DECIMAL(18,2))) AS DOUBLE)/count(*) AS cov_b,
               CAST(sum(CAST(l_tax AS DECIMAL(18,2))) AS DOUBLE)/count(*) AS cov_c,
               CAST(count(*) AS DOUBLE) AS cov_d
        FROM lineitem GROUP BY 1, 2))"""


def CAL(dt: str = "dt") -> str:
    return f"""CAST(year({dt}) AS INTEGER) AS Year, CAST(quarter({dt}) AS INTEGER) AS Quarter,
         CAST(month({dt}) AS INTEGER) AS Month, CAST(day({dt}) AS INTEGER) AS Day, CAST(weekofyear({dt}) AS INTEGER) AS WeekOfYear,
         CAST(dayofweek({dt}) + 1 AS INTEGER) AS DayOfWeek, monthname({dt}) AS MonthName,
         dayname({dt}) AS DayName,
         CAST(CASE WHEN dayofweek({dt}) IN (0, 6) THEN 1 ELSE 0 END AS INTEGER) AS IsWeekend,
         CASE WHEN month({dt}) IN (12, 1, 2) THEN 'Winter' WHEN month({dt}) IN (3, 4, 5) THEN 'Spring'
              WHEN month({dt}) IN (6, 7, 8) THEN 'Summer' ELSE 'Fall' END AS Season"""


FEAT = f"""feat AS (SELECT *, {CAL()} FROM panel)"""

GAPS = f"""feat AS (SELECT *, {CAL()} FROM panel
  WHERE year(dt) <> 1994 AND NOT (year(dt) = 1996 AND month(dt) IN (3, 4)))"""

DIRTY = """dirty0 AS (
  SELECT entity, dt,
         CASE year(dt) % 3 WHEN 0 THEN strftime(dt, '%d-%m-%Y') WHEN 1 THEN strftime(dt, '%Y-%m-%d')
                           ELSE strftime(dt, '%d/%m/%Y') END AS dt_raw,
         CASE WHEN (entity + weekofyear(dt)) % 13 = 0 THEN NULL ELSE CAST(value AS DOUBLE) END AS value,
         flag,
         CASE WHEN (entity * weekofyear(dt)) % 29 = 0 THEN NULL ELSE cov_a END AS cov_a,
         cov_b, cov_c, cov_d
  FROM panel),
dirty AS (
  SELECT * EXCLUDE (dt) FROM dirty0
  UNION ALL
  SELECT * EXCLUDE (dt) FROM dirty0 WHERE entity % 10 = 0 AND month(dt) = 6)"""

DAILY = """daily AS (
  SELECT o_custkey AS entity, CAST(o_orderdate AS DATE) AS dt,
         CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS value
  FROM orders GROUP BY 1, 2)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def WIN(k: int) -> str:
    """Trailing k-row frame per entity."""
    return f"(PARTITION BY entity ORDER BY dt ROWS BETWEEN {k - 1} PRECEDING AND CURRENT ROW)"


def RAVG(k: int, v: str = "value") -> str:
    w = WIN(k)
    return R(f"CAST(sum({v}) OVER {w} AS DOUBLE) / nullif(count({v}) OVER {w}, 0)")


def RSUM(k: int, v: str = "value") -> str:
    return R(f"CAST(sum({v}) OVER {WIN(k)} AS DOUBLE)")


ORD = "(PARTITION BY entity ORDER BY dt)"
