"""SQL that gives the same tables as ``queries``, for DuckDB.

Written from the definitions, with joins, correlated steps and calendars in place
of the fused aggregates and windows of the library.
"""

from __future__ import annotations

from wattfolio import fixed

ORACLE: dict[str, str] = {}

# --- shared tables

LEVELS = """levels AS (
  SELECT o_orderpriority AS country, CAST(o_orderdate AS DATE) AS d, SUM(o_totalprice) AS v
  FROM orders GROUP BY 1, 2)"""

SEASON_DAYS = f"""{LEVELS}, days AS (
  SELECT country, d, strftime(d, '%m-%d') AS k, year(d) AS y, v
  FROM levels WHERE strftime(d, '%m-%d') <> '02-29')"""

BALANCE = """imp AS (
  SELECT CAST(l_shipdate AS DATE) AS d, SUM(l_quantity) AS i
  FROM lineitem WHERE l_returnflag = 'N' GROUP BY 1), exp AS (
  SELECT CAST(l_shipdate AS DATE) AS d, SUM(l_quantity) AS e
  FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1), bal AS (
  SELECT d, i, e, i - e AS diff FROM imp LEFT JOIN exp USING (d))"""


def positioned(minutes: int) -> str:
    return f"""pos AS (
  SELECT l_linestatus AS unit,
         l_shipdate + to_minutes(CAST((l_linenumber - 1) * {minutes} AS BIGINT)) AS ts,
         CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS q, l_extendedprice AS energy
  FROM lineitem)"""


def german(d: str) -> str:
    months = (
        "['Januar','Februar','März','April','Mai','Juni','Juli','August',"
        "'September','Oktober','November','Dezember']"
    )
    return f"(day({d}) || '. ' || {months}[month({d})] || ' ' || year({d}))"


def first_monday(y: str) -> str:
    """First Monday of a year."""
    return f"(date_trunc('week', make_date({y}, 1, 7))::DATE)"


# --- sums, duplicates, totals

ORACLE["daily_sum"] = f"""WITH {LEVELS}
SELECT country, strftime(d, '%Y-%m-%d') AS date, round(v, 6) AS "full" FROM levels"""

ORACLE["weekly_sum"] = """WITH w AS (
  SELECT o_orderpriority AS country, o_orderstatus AS status,
         CAST(date_trunc('week', o_orderdate) AS DATE) + 6 AS e, SUM(o_totalprice) AS v
  FROM orders GROUP BY 1, 2, 3), span AS (
  SELECT country, status, MIN(e) AS a, MAX(e) AS b FROM w GROUP BY 1, 2), cal AS (
  SELECT country, status, CAST(unnest(generate_series(a, b, INTERVAL 7 DAY)) AS DATE) AS e FROM span)
SELECT country, status, strftime(e, '%Y-%m-%d') AS week_end, round(coalesce(v, 0), 6) AS "full",
       strftime(e, '%G-%V') AS year_week, strftime(e, '%G') AS year, strftime(e, '%V') AS week_num
FROM cal LEFT JOIN w USING (country, status, e)"""

ORACLE["monthly_mean_of_sums"] = """WITH s AS (
  SELECT o_orderpriority AS country, year(o_orderdate) AS y, month(o_orderdate) AS month,
         SUM(o_totalprice) AS v
  FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01' GROUP BY 1, 2, 3)
SELECT country, CAST(month AS INTEGER) AS month, round(AVG(v), 6) AS mean FROM s GROUP BY 1, 2"""

ORACLE["totals"] = """SELECT o_orderpriority AS country,
  round(SUM(o_totalprice) / 1000, 6) AS total, round(MAX(o_totalprice) / 1000, 6) AS maximum,
  round(MIN(o_totalprice) / 1000, 6) AS minimum FROM orders GROUP BY 1"""

ORACLE["dedup_readings"] = f"""WITH {positioned(60)}
SELECT DISTINCT unit, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS date, q AS quantity FROM pos"""

AGED = """aged AS (
  SELECT l_shipdate + to_minutes(CAST((l_linenumber - 1) * 60 AS BIGINT)) AS ts, l_orderkey AS age,
         CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS q FROM lineitem), newest AS (
  SELECT ts, q FROM aged QUALIFY row_number() OVER (PARTITION BY ts ORDER BY age DESC, q DESC) = 1)"""

ORACLE["newest_readings"] = f"""WITH {AGED}
SELECT 'all' AS unit, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS date, q AS quantity FROM newest"""

ORACLE["position_to_timestamp"] = """SELECT event_id,
  strftime(ts + to_minutes((CAST(json_extract_string(props, '$.k') AS BIGINT) - 1) * 60),
           '%Y-%m-%d %H:%M:%S.%f') AS reading_time FROM events"""

ORACLE["share_of_total"] = f"""WITH {BALANCE}
SELECT strftime(d, '%Y-%m-%d') AS date, round(i, 6) AS import,
       round(i / (SELECT SUM(i) FROM bal WHERE year(d) = 1997), 6) AS share
FROM bal WHERE year(d) = 1997"""

ORACLE["union_all"] = """SELECT strftime(CAST(l_shipdate AS DATE), '%Y-%m-%d') AS date,
  round(SUM(l_quantity), 6) AS value, CASE l_returnflag WHEN 'R' THEN 'export' WHEN 'A' THEN 'transit' END AS direction
FROM lineitem GROUP BY 1, l_returnflag"""

# --- windows

ORACLE["rolling_median_7"] = f"""WITH {LEVELS}, m AS (
  SELECT *, COUNT(v) OVER w AS n, median(v) OVER w AS med FROM levels
  WINDOW w AS (PARTITION BY country ORDER BY d ROWS 6 PRECEDING))
SELECT country, strftime(d, '%Y-%m-%d') AS date, round(v, 6) AS "full",
       round(CASE WHEN n = 7 THEN med END, 6) AS median FROM m"""

ORACLE["rolling_median_dense"] = f"""WITH {LEVELS}, span AS (
  SELECT country, MIN(d) AS a, MAX(d) AS b FROM levels GROUP BY 1), cal AS (
  SELECT country, CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS d FROM span), f AS (
  SELECT country, d, v FROM cal LEFT JOIN levels USING (country, d)), m AS (
  SELECT *, COUNT(v) OVER w AS n, median(v) OVER w AS med FROM f
  WINDOW w AS (PARTITION BY country ORDER BY d ROWS 6 PRECEDING))
SELECT country, strftime(d, '%Y-%m-%d') AS date, round(v, 6) AS "full",
       round(CASE WHEN n = 7 THEN med END, 6) AS median FROM m"""

QUARTERS = f"""{positioned(15)}, quarters AS (SELECT ts, SUM(energy) AS v FROM pos GROUP BY 1)"""

ORACLE["rolling_median_15min"] = f"""WITH {QUARTERS}, m AS (
  SELECT *, COUNT(v) OVER w AS n, median(v) OVER w AS med FROM quarters WINDOW w AS (ORDER BY ts ROWS 6 PRECEDING))
SELECT strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS date, round(v, 6) AS energy, round(CASE WHEN n = 7 THEN med END, 6) AS median FROM m"""

ORACLE["difference_15min"] = f"""WITH {QUARTERS}
SELECT strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS date, round(v, 6) AS energy, round(v - LAG(v) OVER (ORDER BY ts), 6) AS change FROM quarters"""

ORACLE["weeks_filled_in_blocks"] = """WITH w AS (
  SELECT o_orderpriority AS country, o_orderstatus AS status,
         CAST(date_trunc('week', o_orderdate) AS DATE) + 6 AS e, SUM(o_totalprice) AS v
  FROM orders WHERE o_totalprice > 400000 GROUP BY 1, 2, 3), span AS (
  SELECT country, status, MIN(e) AS a, MAX(e) AS b FROM w GROUP BY 1, 2), cal AS (
  SELECT country, status, CAST(unnest(generate_series(a, b, INTERVAL 7 DAY)) AS DATE) AS e FROM span)
SELECT country, status, strftime(e, '%Y-%m-%d') AS week_end, round(coalesce(v, 0), 6) AS "full"
FROM cal LEFT JOIN w USING (country, status, e)"""

ORACLE["day_over_day_diff"] = f"""WITH {LEVELS}
SELECT country, strftime(d, '%Y-%m-%d') AS date, round(v, 6) AS "full",
       round(v - LAG(v) OVER (PARTITION BY country ORDER BY d), 6) AS change FROM levels"""

ORACLE["latest_value"] = f"""WITH {LEVELS}
SELECT country, strftime(d, '%Y-%m-%d') AS date, round(v, 6) AS "full" FROM levels
QUALIFY row_number() OVER (PARTITION BY country ORDER BY d DESC) = 1"""

ORACLE["last_day_dropped"] = f"""WITH {LEVELS}
SELECT country, strftime(d, '%Y-%m-%d') AS date, round(v, 6) AS "full" FROM levels
WHERE d < (SELECT MAX(d) FROM levels x WHERE x.country = levels.country)"""

# --- seasonal tables

STATS = """round(m, 6) AS Mittelwert, round(x, 6) AS Maximum, round(n, 6) AS Minimum"""

ENVELOPE = f"""WITH {SEASON_DAYS}, env AS (
  SELECT country, k, AVG(v) AS m, MAX(v) AS x, MIN(v) AS n
  FROM days WHERE d <= DATE '1999-12-31' GROUP BY 1, 2), cur AS (
  SELECT country, k, MAX(CASE WHEN y = 2001 THEN v END) AS a, MAX(CASE WHEN y = 2000 THEN v END) AS b
  FROM days WHERE y IN (2000, 2001) GROUP BY 1, 2), j AS (
  SELECT * FROM cur FULL OUTER JOIN env USING (country, k))"""

ORACLE["seasonal_envelope"] = f"""{ENVELOPE}
SELECT country, k AS season_key, round(a, 6) AS "2001", round(b, 6) AS "2000", {STATS} FROM j"""
ORACLE["season_outer_join"] = ORACLE["seasonal_envelope"]

PIVOTED = ",\n       ".join(f'round(MAX(v) FILTER (WHERE y = {y}), 6) AS "{y}"' for y in range(2001, 1994, -1))
ORACLE["pivot_years"] = f"""WITH {SEASON_DAYS}
SELECT country, k AS season_key,
       {PIVOTED}
FROM days WHERE y BETWEEN 1995 AND 2001 GROUP BY 1, 2"""

ORACLE["year_over_year"] = f"""WITH {SEASON_DAYS}
SELECT r.country, r.k AS season_key, round(b.v, 6) AS "2001", round(a.v, 6) AS "2000",
       round(r.v, 6) AS "1999"
FROM (SELECT * FROM days WHERE y = 1999) r
LEFT JOIN (SELECT * FROM days WHERE y = 2000) a ON a.country = r.country AND a.k = r.k
LEFT JOIN (SELECT * FROM days WHERE y = 2001) b ON b.country = r.country AND b.k = r.k"""

# --- balance

ORACLE["flow_balance"] = """WITH imp AS (
  SELECT l_linestatus AS operator, CAST(l_shipdate AS DATE) AS d, SUM(l_quantity) AS i
  FROM lineitem WHERE l_returnflag = 'N' GROUP BY 1, 2), exp AS (
  SELECT l_linestatus AS operator, CAST(l_shipdate AS DATE) AS d, SUM(l_quantity) AS e
  FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1, 2)
SELECT operator, strftime(d, '%Y-%m-%d') AS date, round(i, 6) AS import, round(e, 6) AS export,
       round(i - e, 6) AS diff
FROM imp LEFT JOIN exp USING (operator, d)"""
ORACLE["flow_balance_join"] = ORACLE["flow_balance"]

ORACLE["seasonal_weight_offset"] = f"""WITH {BALANCE}, g AS (
  SELECT strftime(d, '%m-%d') AS k, i / SUM(i) OVER () AS weight FROM bal WHERE year(d) = 1997)
SELECT strftime(d, '%Y-%m-%d') AS date, round(weight, 6) AS weight,
       round(i + CASE WHEN d >= DATE '1997-01-01' THEN coalesce(9190 * weight, 0) ELSE 0 END, 6) AS import
FROM bal LEFT JOIN g ON strftime(bal.d, '%m-%d') = g.k"""
ORACLE["weight_join"] = ORACLE["seasonal_weight_offset"]

# --- quality

UNITS = """f AS (
  SELECT o_orderstatus AS direction, o_orderpriority AS point,
         CASE WHEN o_totalprice > 400000 AND (
                (o_orderstatus = 'F' AND o_orderpriority = '3-MEDIUM')
                OR (o_orderstatus = 'O' AND o_orderpriority IN ('4-NOT SPECIFIED', '5-LOW')))
              THEN 'MWh/d' ELSE 'kWh/d' END AS unit,
         CAST(o_orderdate AS DATE) AS d, o_totalprice AS v FROM orders)"""

ORACLE["unit_check"] = f"""WITH {UNITS}
SELECT direction, point, COUNT(*) AS rows, COUNT(*) FILTER (WHERE unit <> 'kWh/d') AS bad_unit,
       CASE WHEN COUNT(*) FILTER (WHERE unit <> 'kWh/d') = 0 THEN 1 ELSE 0 END AS passes
FROM f GROUP BY 1, 2"""

ORACLE["flow_check"] = """WITH f AS (
  SELECT CASE l_returnflag WHEN 'N' THEN 'import' WHEN 'R' THEN 'export' ELSE 'transit' END AS direction, l_linenumber AS point,
         l_returnflag = 'N' AND l_linenumber = 3 AND l_shipdate >= DATE '1998-01-01' AS bad
  FROM lineitem)
SELECT direction, point, COUNT(*) AS rows, CAST(0 AS BIGINT) AS bad_unit, COUNT(*) FILTER (WHERE bad) AS bad_directionKey,
       CASE WHEN COUNT(*) FILTER (WHERE bad) = 0 THEN 1 ELSE 0 END AS passes
FROM f GROUP BY 1, 2"""

ORACLE["unit_quarantine"] = f"""WITH {UNITS}
SELECT direction, point, strftime(d, '%Y-%m-%d') AS date, round(SUM(v), 6) AS value FROM f
WHERE (direction, point) NOT IN (SELECT (direction, point) FROM f WHERE unit <> 'kWh/d')
GROUP BY 1, 2, 3"""

ORACLE["unit_stop"] = f"""WITH {UNITS}, stop AS (
  SELECT direction, MIN(point) AS p FROM f WHERE unit <> 'kWh/d' GROUP BY 1)
SELECT direction, point, strftime(d, '%Y-%m-%d') AS date, round(SUM(v), 6) AS value
FROM f LEFT JOIN stop USING (direction) WHERE p IS NULL OR point < p GROUP BY 1, 2, 3"""

ORACLE["plausibility_gate"] = f"""WITH {LEVELS}, c AS (
  SELECT country, d, v - LAG(v) OVER (PARTITION BY country ORDER BY d) AS c,
         d = MAX(d) OVER (PARTITION BY country) AS tail FROM levels), l AS (
  SELECT country, c AS last_diff FROM c WHERE tail), r AS (
  SELECT 'reference' AS mode, country, MAX(c) AS hi, MIN(c) AS lo FROM c GROUP BY 2
  UNION ALL SELECT 'exclude_last', country, MAX(c), MIN(c) FROM c WHERE NOT tail GROUP BY 2)
SELECT mode, country, round(hi, 6) AS max_diff, round(lo, 6) AS min_diff,
       round(last_diff, 6) AS last_diff,
       CASE WHEN hi * 1.25 > last_diff AND lo * 1.5 < last_diff THEN 1 ELSE 0 END AS plausible
FROM r JOIN l USING (country)"""

ORACLE["freshness_gate"] = f"""WITH {positioned(60)}, dd AS (SELECT DISTINCT unit, ts, q FROM pos), w AS (
  SELECT DISTINCT unit, CAST(date_trunc('week', ts) AS DATE) + 6 AS e FROM dd), l AS (
  SELECT unit, MAX(CAST(strftime(e, '%V') AS INTEGER)) AS last_week FROM w
  WHERE e >= DATE '2000-01-01' AND e <= DATE '2001-08-01' AND strftime(e, '%G') = '2001'
    AND strftime(e, '%V') <= '52' GROUP BY 1), m AS (
  SELECT unit, last_week, 'first_monday' AS rule,
         {first_monday("2001")} + (last_week - 1) * 7 AS monday FROM l
  UNION ALL SELECT unit, last_week, 'iso',
         CAST(date_trunc('week', DATE '2001-01-04') AS DATE) + (last_week - 1) * 7 FROM l)
SELECT unit, last_week, rule, strftime(monday, '%Y-%m-%d') AS monday,
       CASE WHEN DATE '2001-08-01' - 16 <= monday THEN 1 ELSE 0 END AS fresh FROM m"""

ORACLE["page_completeness"] = """WITH p AS (
  SELECT l_orderkey, COUNT(DISTINCT l_linenumber) AS pages, MAX(l_linenumber) AS last_page
  FROM lineitem GROUP BY 1)
SELECT l_orderkey, pages, last_page, CASE WHEN pages = last_page THEN 1 ELSE 0 END AS complete FROM p"""

ORACLE["page_drift"] = f"""WITH {LEVELS}, r AS (
  SELECT country, d, row_number() OVER (PARTITION BY country ORDER BY d DESC) AS r FROM levels), p AS (
  SELECT country, d, (r - 1) // 300 + 1 AS page FROM r WHERE country NOT IN ('2-HIGH', '5-LOW') OR r <= 300
  UNION ALL SELECT country, d, r // 300 + 1 FROM r WHERE country = '2-HIGH' AND r >= 300
  UNION ALL SELECT country, d, (r - 2) // 300 + 1 FROM r WHERE country = '5-LOW' AND r > 301), s AS (
  SELECT country, page, MIN(d) AS a, MAX(d) AS b, COUNT(DISTINCT d) AS n FROM p GROUP BY 1, 2), f AS (
  SELECT x.*, y.page AS next, x.a - y.b AS step FROM s x LEFT JOIN s y ON y.country = x.country AND y.page = x.page + 1)
SELECT country, CAST(page AS INTEGER) AS page, strftime(a, '%Y-%m-%d') AS first_day, strftime(b, '%Y-%m-%d') AS last_day,
       n AS days, b - a + 1 - n AS inside, CAST(next AS INTEGER) AS follows,
       CAST(CASE WHEN next IS NOT NULL THEN greatest(0, 1 - step) END AS INTEGER) AS overlap,
       CAST(CASE WHEN next IS NOT NULL THEN greatest(0, step - 1) END AS INTEGER) AS missing FROM f"""

ORACLE["conflicting_readings"] = f"""WITH {positioned(60)}
SELECT unit, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS date, COUNT(DISTINCT q) AS "values"
FROM pos GROUP BY unit, ts HAVING COUNT(DISTINCT q) > 1"""

ORACLE["overlapping_rows"] = """SELECT
  CASE l_returnflag WHEN 'N' THEN 'import' WHEN 'R' THEN 'export' ELSE 'transit' END AS direction,
  l_linestatus AS operator, strftime(l_shipdate, '%Y-%m-%d %H:%M:%S.%f') AS time, COUNT(*) AS rows
FROM lineitem GROUP BY 1, 2, 3 HAVING COUNT(*) > 1"""

# --- scalar functions

ORACLE["calendar_keys"] = f"""WITH t AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders)
SELECT strftime(d, '%Y-%m-%d') AS date,
  CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month,
  strftime(d, '%m-%d') AS month_day, '2001-' || strftime(d, '%m-%d') AS shown_date,
  strftime(CAST(date_trunc('week', d) AS DATE) + 6, '%Y-%m-%d') AS week_end,
  strftime(d, '%G-%V') AS year_week, strftime(d, '%V') AS week_num, CAST(weekofyear(d) AS INTEGER) AS week,
  strftime(d + 1, '%Y-%m-%d') AS next_day, {german("d")} AS german,
  strftime({first_monday("year(d)")} + CAST((weekofyear(d) - 1) * 7 AS INTEGER), '%Y-%m-%d') AS monday,
  strftime(date_trunc('week', d), '%Y-%m-%d') AS iso_monday
FROM t"""

ORACLE["scalar_functions"] = """WITH t AS (SELECT *, round(o_totalprice / 4000, 2) AS lv FROM orders)
SELECT o_orderkey, CAST(split_part(o_orderpriority, '-', 1) AS INTEGER) AS rank,
  TRY_CAST(o_orderstatus AS DOUBLE) AS no_number,
  round(CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE 0 END, 6) AS filled,
  replace(CAST(CAST(round_even(CAST(lv AS DECIMAL(12, 2)), 1) AS DECIMAL(12, 1)) AS VARCHAR), '.', ',') AS comma,
  CAST(round_even(CAST(lv AS DECIMAL(12, 2)), 1) AS DOUBLE) AS one_digit,
  round((o_totalprice - 250000) / 250000 * 100, 6) AS percent
FROM t"""

ORACLE["page_links"] = r"""WITH a AS (
  SELECT page_id, list_filter(
    regexp_extract_all(
      regexp_replace(html, '(?is)<!--.*?-->|<script\b.*?</script>|<style\b.*?</style>', '', 'g'),
      '(?i)<a\s[^>]*>'),
    lambda x: regexp_matches(x, '(?i:\shref\s*=\s*)"/[a-m]')) AS t
  FROM pages)
SELECT page_id, regexp_extract(t[1], '(?i)\shref\s*=\s*"([^"]*)"', 1) AS link FROM a WHERE len(t) > 0"""

# --- reports

ORACLE["gas_balance_report"] = f"""WITH {BALANCE}, b AS (
  SELECT d, (i - e) / 1000 AS diff FROM bal WHERE d < (SELECT MAX(d) FROM bal)), g AS (
  SELECT strftime(d, '%m-%d') AS k, diff / SUM(diff) OVER () AS weight FROM b WHERE year(d) = 1997), o AS (
  SELECT d, diff + CASE WHEN d >= DATE '1997-01-01' THEN coalesce(9190 * weight, 0) ELSE 0 END AS diff
  FROM b LEFT JOIN g ON strftime(b.d, '%m-%d') = g.k), m AS (
  SELECT d, CASE WHEN COUNT(diff) OVER w = 7 THEN median(diff) OVER w END AS med
  FROM o WINDOW w AS (ORDER BY d ROWS 6 PRECEDING)), s AS (
  SELECT year(d) AS y, '2001-' || strftime(d, '%m-%d') AS k, med FROM m)
SELECT r.k AS date_show, round(b.med, 6) AS "2001", round(a.med, 6) AS "2000", round(r.med, 6) AS "1997"
FROM (SELECT * FROM s WHERE y = 1997) r
LEFT JOIN (SELECT * FROM s WHERE y = 2000) a ON a.k = r.k
LEFT JOIN (SELECT * FROM s WHERE y = 2001) b ON b.k = r.k
WHERE r.k <> '2001-02-29'"""

GATE = """c AS (
  SELECT country, d, v - LAG(v) OVER (PARTITION BY country ORDER BY d) AS c FROM levels), p AS (
  SELECT country, CASE WHEN MAX(c) * 1.25 > arg_max(c, d) AND MIN(c) * 1.5 < arg_max(c, d)
                  THEN 1 ELSE 0 END AS plausible FROM c GROUP BY 1)"""

ORACLE["storage_report"] = f"""{ENVELOPE}, {GATE}
SELECT country, '2001-' || k AS date_datawrapper, round(a, 6) AS "2001", round(b, 6) AS "2000",
       {STATS}, plausible FROM j JOIN p USING (country)"""

WEEKLY = """w AS (
  SELECT CAST(date_trunc('week', ts) AS DATE) + 6 AS e, SUM(CAST(q AS INTEGER)) / 1000.0 AS v
  FROM single GROUP BY 1), cal AS (
  SELECT CAST(unnest(generate_series((SELECT MIN(e) FROM w), (SELECT MAX(e) FROM w), INTERVAL 7 DAY)) AS DATE) AS e), f AS (
  SELECT e, strftime(e, '%G') AS y, strftime(e, '%V') AS k, coalesce(v, 0) AS v
  FROM cal LEFT JOIN w USING (e)), env AS (
  SELECT k, AVG(v) AS m, MAX(v) AS x, MIN(v) AS n FROM f WHERE e < DATE '2000-01-01' GROUP BY 1), cur AS (
  SELECT k, MAX(v) FILTER (WHERE y = '2001') AS a, MAX(v) FILTER (WHERE y = '2000') AS b
  FROM f WHERE e >= DATE '2000-01-01' AND e <= DATE '2001-08-01' AND y >= '2000' GROUP BY 1)
SELECT k AS week_num, round(a, 6) AS "2001", round(b, 6) AS "2000", round(m, 6) AS Mittelwert, round(x, 6) AS Maximum, round(n, 6) AS Minimum
FROM cur FULL OUTER JOIN env USING (k) WHERE k <= '52'"""

ORACLE["weekly_generation_report"] = f"WITH {positioned(60)}, single AS (SELECT DISTINCT ts, q FROM pos), {WEEKLY}"
ORACLE["weekly_newest_report"] = f"WITH {AGED}, single AS (SELECT ts, q FROM newest), {WEEKLY}"

ORACLE["weekly_envelope_15min"] = f"""WITH {positioned(15)}, w AS (
  SELECT CAST(date_trunc('week', ts) AS DATE) + 6 AS e, SUM(energy) AS v FROM pos GROUP BY 1), cal AS (
  SELECT CAST(unnest(generate_series((SELECT MIN(e) FROM w), (SELECT MAX(e) FROM w), INTERVAL 7 DAY)) AS DATE) AS e), f AS (
  SELECT e, strftime(e, '%G') AS y, weekofyear(e) AS k, coalesce(v, 0) / 100 AS v
  FROM cal LEFT JOIN w USING (e)), env AS (
  SELECT k, AVG(v) AS m, MAX(v) AS x, MIN(v) AS n FROM f WHERE e <= DATE '1999-12-31' GROUP BY 1), cur AS (
  SELECT k, v AS a FROM f WHERE y = '2000')
SELECT CAST(k AS INTEGER) AS week_num, round(CASE WHEN k <> 39 THEN a END, 6) AS "2000", {STATS}
FROM cur FULL OUTER JOIN env USING (k)"""

NATIONAL = """SELECT CAST(o_orderdate AS DATE) AS d,
  SUM(o_totalprice) FILTER (WHERE o_orderstatus = 'F') AS a,
  SUM(o_totalprice) FILTER (WHERE o_orderstatus = 'O') AS b,
  SUM(o_totalprice) FILTER (WHERE o_orderstatus = 'P') AS c,
  CAST(SUM(CAST(round(o_totalprice * 100) AS BIGINT)) AS DOUBLE) / COUNT(*) / 100 AS m, MIN(o_totalprice) AS n, MAX(o_totalprice) AS x
FROM orders WHERE o_orderdate >= TIMESTAMP '2000-01-01' GROUP BY 1"""

FINAL = """SELECT CAST(l_shipdate AS DATE) AS d,
  SUM(l_quantity) FILTER (WHERE l_linestatus = 'O') AS a,
  SUM(l_quantity) FILTER (WHERE l_linestatus = 'F') AS b,
  CAST(SUM(CAST(round(l_extendedprice * 100) AS BIGINT)) AS DOUBLE) / COUNT(*) / 100 AS m, MIN(l_extendedprice) AS n, MAX(l_extendedprice) AS x
FROM lineitem WHERE l_shipdate >= TIMESTAMP '2000-01-01' GROUP BY 1"""

ORACLE["source_national_use"] = f"""SELECT strftime(d, '%Y-%m-%d') AS date,
  round(a, 6) AS "Verbrauch gemeldet", round(b, 6) AS "Verbrauch geschätzt", round(c, 6) AS "Prognose",
  {STATS} FROM ({NATIONAL})"""

ORACLE["source_final_use"] = f"""SELECT strftime(d, '%Y-%m-%d') AS date,
  round(a, 6) AS "Endverbrauch gemeldet", round(b, 6) AS "Endverbrauch geschätzt", {STATS} FROM ({FINAL})"""

ORACLE["consumption_tables"] = f"""SELECT 'landesverbrauch' AS usage, * FROM ({ORACLE["source_national_use"]})
UNION ALL BY NAME SELECT 'endverbrauch' AS usage, * FROM ({ORACLE["source_final_use"]})"""

MONTH = f"""WITH {positioned(15)}, u AS (
  SELECT SUM(energy) / 1000000 AS u FROM pos
  WHERE ts >= TIMESTAMP '2000-09-01' AND ts <= TIMESTAMP '2000-09-30 23:45:00'), y AS (
  SELECT year(ts) AS y, SUM(energy) AS v FROM pos
  WHERE ts < TIMESTAMP '2000-01-01' AND month(ts) = 9 GROUP BY 1), t AS (
  SELECT (SELECT u FROM u) AS u, (SELECT AVG(v) / 1000000 FROM y) AS a)"""

ORACLE["month_vs_average"] = f"""{MONTH}
SELECT round_even(u, 1) AS usage, round_even(a, 1) AS average, round_even(u - a, 1) AS difference,
       round_even((u - a) / a * 100, 1) AS percent FROM t"""

ORACLE["month_summary"] = f"""{MONTH}
SELECT 'Verbrauch vom 2000-09-01 bis 2000-09-30 23:45:00: ' || printf('%.1f', u) || ' Gigawattstunden' AS usage_line,
  'Durchschnitts-Verbrauch im Monat 9: ' || printf('%.1f', a) || ' Gigawattstunden' AS average_line,
  'Differenz zum Durchschnittsverbrauch: ' || printf('%.1f', u - a) || ' GWh oder '
    || printf('%.1f', (u - a) / a * 100) || ' Prozent' AS difference_line FROM t"""

ORACLE["annotations"] = f"""WITH {LEVELS}, l AS (
  SELECT country, d, replace(printf('%.1f', round_even(v / 100000, 1)), '.', ',') AS t FROM levels
  QUALIFY row_number() OVER (PARTITION BY country ORDER BY d DESC) = 1)
SELECT country, strftime(d, '%Y-%m-%d') AS date, t AS latest_value,
  'Füllstand ' || country || ': <u>' || t || ' Prozent</u>' AS title,
  '    Mittelwert, Maximum und Minimum der Jahre 2011 bis 2021.     Wird täglich aktualisiert. Datenstand: '
    || {german("d")} || '.    ' AS note FROM l"""

ORACLE["use_annotations"] = f"""WITH n AS (SELECT MAX(d) + 1 AS d FROM ({NATIONAL}) WHERE b IS NOT NULL)
SELECT strftime(d, '%Y-%m-%d') AS last_updated, usage,
  'Mittelwert, Mininum und Maximum beziehen sich auf die letzten fünf Jahre. ' || extra
    || 'Wird täglich aktualisiert, zuletzt am ' || {german("d")} || '.' || chr(10) AS note
FROM n, (VALUES ('landesverbrauch', ''),
                ('endverbrauch', 'An den Wochenenden wird weniger Strom verbraucht. ')) v(usage, extra)"""

ORACLE["generation_annotations"] = f"""WITH f AS ({ORACLE["freshness_gate"]})
SELECT unit, last_week, monday, fresh, CASE WHEN fresh = 1 THEN
  'Mittelwert, Maximum und Minimum der Jahre 2015 bis 2021. Wird wöchentlich aktualisiert, zuletzt am '
    || '1. August 2001.' END AS note
FROM f WHERE rule = 'first_monday'"""

ORACLE["gas_annotations"] = f"""WITH r AS ({ORACLE["gas_balance_report"]})
SELECT COUNT(*) AS rows, 'Letzte zwei Tage wegen unvollständiger Daten nicht berücksichtigt. '
  || 'In der Statistik fehlen derzeit rund 9 TWh Gas pro Jahr wegen Meldelücken. '
  || 'Diese Summe wird täglich gewichtet den gemeldeten Werten zugerechnet. '
  || 'Wird täglich aktualisiert, zuletzt am 1. August 2001.' AS note FROM r"""

ORACLE["gas_balance_by_operator"] = """WITH imp AS (
  SELECT l_linestatus AS op, CAST(l_shipdate AS DATE) AS d, SUM(l_quantity) AS i
  FROM lineitem WHERE l_returnflag = 'N' GROUP BY 1, 2), exp AS (
  SELECT l_linestatus AS op, CAST(l_shipdate AS DATE) AS d, SUM(l_quantity) AS e
  FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1, 2), z AS (
  SELECT op, MAX(d) AS z FROM imp GROUP BY 1), b AS (
  SELECT op, d, (i - e) / 1000 AS diff FROM imp LEFT JOIN exp USING (op, d) JOIN z USING (op) WHERE d < z), g AS (
  SELECT op, strftime(d, '%m-%d') AS k, diff / SUM(diff) OVER (PARTITION BY op) AS weight
  FROM b WHERE year(d) = 1997), o AS (
  SELECT b.op, d, diff + CASE WHEN d >= DATE '1997-01-01' THEN coalesce(9190 * weight, 0) ELSE 0 END AS diff
  FROM b LEFT JOIN g ON strftime(b.d, '%m-%d') = g.k AND b.op = g.op), m AS (
  SELECT op, d, CASE WHEN COUNT(diff) OVER w = 7 THEN median(diff) OVER w END AS med
  FROM o WINDOW w AS (PARTITION BY op ORDER BY d ROWS 6 PRECEDING)), s AS (
  SELECT op, year(d) AS y, '2001-' || strftime(d, '%m-%d') AS k, med FROM m)
SELECT r.op AS operator, r.k AS date_show, round(b.med, 6) AS "2001", round(a.med, 6) AS "2000",
       round(r.med, 6) AS "1997"
FROM (SELECT * FROM s WHERE y = 1997) r
LEFT JOIN (SELECT * FROM s WHERE y = 2000) a ON a.k = r.k AND a.op = r.op
LEFT JOIN (SELECT * FROM s WHERE y = 2001) b ON b.k = r.k AND b.op = r.op"""

ORACLE["daily_store_update"] = ORACLE["storage_report"]

ORACLE["daily_store_corrections"] = f"""WITH {LEVELS}
SELECT country, strftime(d, '%Y-%m-%d') AS date,
       round(CAST(printf('%.2f', CASE WHEN year(d) = 1997 AND month(d) = 3 THEN v * 2 ELSE v END) AS DOUBLE), 6) AS "full" FROM levels"""

CORRECTED = LEVELS.replace("SUM(o_totalprice) AS v", "SUM(o_totalprice) * CASE WHEN year(CAST(o_orderdate AS DATE)) = 1998 THEN 2 ELSE 1 END AS v")
ORACLE["season_state_report"] = ORACLE["storage_report"].replace(LEVELS, CORRECTED.replace("GROUP BY 1, 2)", "GROUP BY 1, 2, year(CAST(o_orderdate AS DATE)))"))

ORACLE["sink_row_order"] = f"""WITH {SEASON_DAYS}
SELECT country, 'date' AS ordered_by, CAST(row_number() OVER (PARTITION BY country ORDER BY d) AS INTEGER) AS place,
       strftime(d, '%Y-%m-%d') AS key FROM levels
UNION ALL SELECT country, 'season_key', CAST(row_number() OVER (PARTITION BY country ORDER BY k) AS INTEGER), k
FROM (SELECT DISTINCT country, k FROM days)"""

ORACLE["published_parts"] = f"""WITH {LEVELS}
SELECT country, strftime(d, '%Y-%m-%d') AS date, CAST(year(d) AS INTEGER) AS year,
       round(CASE WHEN country < '3' AND year(d) IN (1997, 1999) THEN -v ELSE v END, 6) AS "full" FROM levels"""

# --- files

ORACLE["source_gas_flow_csv"] = """WITH imp AS (
  SELECT CAST(l_shipdate AS DATE) AS d, SUM(l_quantity) AS i FROM lineitem
  WHERE l_returnflag = 'N' AND (l_linestatus = 'O' OR l_linenumber > 2) GROUP BY 1), exp AS (
  SELECT CAST(l_shipdate AS DATE) AS d, SUM(l_quantity) AS e FROM lineitem
  WHERE l_returnflag = 'R' GROUP BY 1)
SELECT strftime(d, '%Y-%m-%d') AS date, round(i, 6) AS import, round(e, 6) AS export,
       round(i - e, 6) AS diff FROM imp LEFT JOIN exp USING (d)"""

ORACLE["source_flow_history"] = ORACLE["source_gas_flow_csv"]

ORACLE["source_flow_store"] = ORACLE["source_gas_flow_csv"]

ORACLE["source_storage_pages"] = ORACLE["daily_sum"]

ORACLE["source_page_check"] = f"""WITH {LEVELS}, n AS (
  SELECT country, CAST(ceil(COUNT(*) / 300.0) AS INTEGER) AS p FROM levels GROUP BY 1)
SELECT country, CAST(p AS BIGINT) AS pages, p AS last_page, 1 AS complete FROM n
UNION ALL SELECT '6-MISSING', 0, NULL, 0"""

ORACLE["source_generation_xml"] = """SELECT
  strftime(l_shipdate + to_hours(CAST(l_linenumber - 1 AS BIGINT)), '%Y-%m-%d %H:%M:%S.%f') AS date,
  CAST(CAST(SUM(l_quantity) AS INTEGER) AS VARCHAR) AS quantity
FROM lineitem GROUP BY l_shipdate, l_linenumber"""

COUNTED = ", ".join(
    f'round(COUNT(*) * {i}.0, 6)::DOUBLE AS "{m}"' for i, m in enumerate(fixed.grid_measures()) if i > 0
)
ORACLE["source_grid_sheets"] = f"""SELECT strftime(CAST(l_shipdate AS DATE), '%Y-%m-%d') AS day,
  round(SUM(l_extendedprice), 6) AS endverbrauchte_energie, {COUNTED} FROM lineitem GROUP BY 1"""

ORACLE["source_grid_layouts"] = ORACLE["source_grid_sheets"]

_MEASURES = fixed.grid_measures()
_TITLES = {1: ["date", *_MEASURES], 0: ["Zeit", *("Summe " + m.replace("_", " ") + " (kWh)" for m in _MEASURES[-10:] + _MEASURES[:-10])]}
ORACLE["sheet_headers"] = f"""SELECT CAST(year(ts) >= 1998 AS INTEGER) AS known,
  CASE WHEN year(ts) >= 1998 THEN '{",".join(_TITLES[1])}' ELSE '{",".join(_TITLES[0])}' END AS header, COUNT(DISTINCT year(ts)) AS files
FROM (WITH {positioned(15)} SELECT ts FROM pos) GROUP BY 1, 2"""

ORACLE["source_weekly_routes"] = """WITH w AS (
  SELECT l_linestatus AS s, CAST(date_trunc('week', l_shipdate) AS DATE) + 6 AS e, l_quantity AS q
  FROM lineitem), k AS (SELECT DISTINCT weekofyear(e) AS week FROM w), r AS (
  SELECT * FROM (VALUES ('O', 'Nord Stream'), ('F', 'Yamal (BY,PL)')) a(s, series),
                (VALUES ('1995'), ('1996'), ('1997'), ('1998'), ('1999'), ('2000'), ('2001')) b(period)), v AS (
  SELECT s, weekofyear(e) AS week, strftime(e, '%G') AS period, SUM(q) AS value FROM w GROUP BY 1, 2, 3)
SELECT CAST(k.week AS INTEGER) AS week, r.series AS series, r.period AS period, round(v.value, 6) AS value
FROM k CROSS JOIN r LEFT JOIN v ON v.week = k.week AND v.s = r.s AND v.period = r.period"""

ORACLE["source_route_snapshots"] = f"""WITH r AS ({ORACLE["source_weekly_routes"]})
SELECT t.snapshot_date, r.* FROM r, (VALUES ('2001-01-10', '2000'), ('2002-01-09', '2001')) t(snapshot_date, newest)
WHERE period <= newest"""

ORACLE["source_route_store"] = ORACLE["source_route_snapshots"]

ORACLE["sink_texts"] = r"""WITH t AS (
  SELECT page_id, 'page' AS kind, html AS text FROM pages
  UNION ALL SELECT page_id, 'blanks', '    ' || url || '  ' FROM pages
  UNION ALL SELECT page_id, 'break', url || chr(10) FROM pages
  UNION ALL SELECT page_id, 'quotes', 'say "' || url || '", twice' FROM pages
  UNION ALL SELECT page_id, 'empty', '' FROM pages
  UNION ALL SELECT page_id, 'missing', NULL FROM pages)
SELECT page_id, kind, CAST(text IS NULL AS INTEGER) AS missing, md5(text) AS digest FROM t"""

ORACLE["sink_snapshot"] = f"""WITH s AS ({ORACLE["storage_report"]})
SELECT s.* EXCLUDE (plausible), t.snapshot FROM s, (VALUES ('2001-08-01'), ('2001-08-02'), ('current')) t(snapshot)
WHERE plausible = 1"""
