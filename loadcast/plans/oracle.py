"""The same answers in portable SQL, written independently of the operators."""

from __future__ import annotations

from loadcast.functions.weather import CATEGORIES
from loadcast.plans.inputs import WEATHER_TEXTS

_TEXT_CASE = " ".join(
    f"WHEN {i} THEN '{t}'" for i, t in enumerate(WEATHER_TEXTS) if t is not None
)

OBS = f"""
obs AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
         CAST(l_shipdate AS DATE) AS date,
         l_quantity - 10 AS max_temp,
         l_quantity - 10 - round(l_discount * 100) AS min_temp,
         CASE l_partkey % 17 {_TEXT_CASE} ELSE NULL END AS weather
  FROM lineitem
)"""

MERGED = f"""{OBS},
weather_daily AS (
  SELECT date, max_temp, min_temp, weather FROM (
    SELECT *, row_number() OVER (PARTITION BY date
      ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, max_temp, min_temp) AS rn FROM obs) t
  WHERE rn = 1
),
power_daily AS (
  SELECT CAST(o_orderdate AS DATE) AS date, CAST(floor(max(o_totalprice) / 100) AS BIGINT) AS max_power
  FROM orders GROUP BY CAST(o_orderdate AS DATE)
),
merged AS (
  SELECT date, max_temp, min_temp, weather, max_power FROM weather_daily JOIN power_daily USING (date)
)"""

# Holidays of the data's years by rule: the day of each statutory holiday, the moved day after a Sunday
# and the day caught between two holidays.
HOLIDAYS = """
cal AS (
  SELECT CAST(d AS DATE) AS d, CAST(year(d) AS INTEGER) AS y, CAST(month(d) AS INTEGER) AS m,
         CAST(day(d) AS INTEGER) AS dd, CAST(isodow(d) AS INTEGER) AS wd
  FROM generate_series(TIMESTAMP '1995-01-01', TIMESTAMP '2002-12-31', INTERVAL 1 DAY) AS g(d)
),
named AS (
  SELECT d, wd FROM cal WHERE
       (m = 1 AND dd = 1)
    OR (m = 1 AND ((y < 2000 AND dd = 15) OR (y >= 2000 AND wd = 1 AND dd BETWEEN 8 AND 14)))
    OR (m = 2 AND dd = 11)
    OR (m = 3 AND dd = CAST(floor(20.8431 + 0.242194 * (y - 1980) - floor((y - 1980) / 4.0)) AS INTEGER))
    OR (m = 4 AND dd = 29)
    OR (m = 5 AND dd IN (3, 5))
    OR (m = 7 AND dd = 20 AND y >= 1996)
    OR (m = 9 AND dd = 15)
    OR (m = 9 AND dd = CAST(floor(23.2488 + 0.242194 * (y - 1980) - floor((y - 1980) / 4.0)) AS INTEGER))
    OR (m = 10 AND ((y < 2000 AND dd = 10) OR (y >= 2000 AND wd = 1 AND dd BETWEEN 8 AND 14)))
    OR (m = 11 AND dd IN (3, 23))
    OR (m = 12 AND dd = 23)
),
hol AS (
  SELECT d FROM named
  UNION
  SELECT CAST(n.d + INTERVAL 1 DAY AS DATE) FROM named n
    WHERE n.wd = 7 AND CAST(n.d + INTERVAL 1 DAY AS DATE) NOT IN (SELECT d FROM named)
  UNION
  SELECT CAST(a.d + INTERVAL 1 DAY AS DATE) FROM named a JOIN named b
    ON b.d = CAST(a.d + INTERVAL 2 DAY AS DATE)
    WHERE isodow(CAST(a.d + INTERVAL 1 DAY AS DATE)) <> 7
)"""


def category_sql(text: str = "weather") -> str:
    def has(*words: str) -> str:
        return "(" + " OR ".join(f"contains({text}, '{w}')" for w in words) + ")"

    rain, sun, cloud = has("雨", "あめ"), has("晴", "日射"), has("曇", "くもり")
    thunder = has("雷")
    return f"""CASE
    WHEN {text} IS NULL THEN '不明'
    WHEN {has('雪', 'ゆき')} THEN '雪'
    WHEN {thunder} AND {rain} THEN '雷雨'
    WHEN {thunder} AND {sun} THEN '晴れ(雷あり)'
    WHEN {thunder} AND {cloud} THEN '曇り(雷あり)'
    WHEN {thunder} THEN '雷'
    WHEN {has('快晴')} THEN '快晴'
    WHEN {sun} AND {cloud} THEN '晴れ時々曇り'
    WHEN {sun} AND {rain} THEN '晴れ時々雨'
    WHEN {sun} THEN '晴れ'
    WHEN {cloud} AND {rain} THEN '曇り時々雨'
    WHEN {cloud} THEN '曇り'
    WHEN {rain} THEN '雨'
    ELSE 'その他' END"""


NUMERIC = """
  (max_temp + min_temp) / 2 AS avg,
  max_temp - min_temp AS rng,
  CASE WHEN (max_temp + min_temp) / 2 > 18 THEN (max_temp + min_temp) / 2 - 18 ELSE 0.0 END AS cdd,
  CASE WHEN (max_temp + min_temp) / 2 < 18 THEN 18 - (max_temp + min_temp) / 2 ELSE 0.0 END AS hdd,
  CAST(max_temp >= 30 AS INTEGER) AS hot,
  CAST(min_temp <= 5 AS INTEGER) AS cold"""

CALENDAR = """
  CAST(year(date) AS INTEGER) AS year,
  CAST(month(date) AS INTEGER) AS month,
  CAST(day(date) AS INTEGER) AS day,
  CAST(isodow(date) - 1 AS INTEGER) AS dow,
  round(sin(2 * pi() * (isodow(date) - 1) / 7), 9) AS dow_sin,
  round(cos(2 * pi() * (isodow(date) - 1) / 7), 9) AS dow_cos,
  round(sin(2 * pi() * month(date) / 12), 9) AS mon_sin,
  round(cos(2 * pi() * month(date) / 12), 9) AS mon_cos,
  CAST(isodow(date) >= 6 AS INTEGER) AS weekend,
  CAST(date IN (SELECT d FROM hol) AS INTEGER) AS holiday"""

FEATURES = f"""{MERGED},{HOLIDAYS},
features AS (
  SELECT date, {category_sql()} AS weather_category, max_temp, min_temp, max_power,
  {NUMERIC},
  {CALENDAR}
  FROM merged
)"""

ONE_HOT = ", ".join(
    f"""CAST(weather_category = '{c}' AS INTEGER) AS "weather_category_{c}\"""" for c in sorted(CATEGORIES)
)
MATRIX = (
    "max_temp, min_temp, max_power, avg, rng, cdd, hdd, hot, cold, year, month, day, dow, dow_sin, dow_cos, "
    f"mon_sin, mon_cos, weekend, holiday, {ONE_HOT}"
)
LATEST = f"""{OBS},
latest AS (
  SELECT * FROM (
    SELECT *, strftime(date, '%Y-%m-%d') AS record_id, row_number() OVER (PARTITION BY date
      ORDER BY l_orderkey DESC, l_linenumber DESC, l_partkey DESC, l_suppkey DESC, max_temp, min_temp, weather) AS rn
    FROM obs) t
  WHERE rn = 1 AND date BETWEEN DATE '1996-01-01' AND DATE '2000-12-31'
)"""
ERRORS = f"""{MERGED},
scored AS (
  SELECT date, strftime(date, '%Y-%m') AS month, CAST(max_power AS DOUBLE) AS y,
         4000 + 10 * max_temp - 5 * min_temp AS p FROM merged
)"""
METRIC_SQL = """count(*) AS n, round(avg((y - p) * (y - p)), {d}) AS mse, round(sqrt(avg((y - p) * (y - p))), {d}) AS rmse,
  round(avg(abs(y - p)), {d}) AS mae,
  round(CASE WHEN count(*) < 2 THEN NULL WHEN var_pop(y) > 0 THEN 1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*))
    WHEN avg(abs(y - p)) = 0 THEN 1.0 ELSE 0.0 END, {d}) AS r2"""
INTEGERS = ("hot", "cold", "year", "month", "day", "dow")
CYCLES = ("dow_sin", "dow_cos", "mon_sin", "mon_cos")
PROFILED = (
    "max_temp", "min_temp", "max_power", "avg", "rng", "cdd", "hdd", *INTEGERS, *CYCLES, "weekend", "holiday",
)
LONG = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", CAST({c} AS DOUBLE) AS x FROM wide WHERE {c} IS NOT NULL" for c in PROFILED
)
STATS = """stats AS (
  SELECT "column", min(x) AS lo, max(x) AS hi, count(*) AS n, stddev_samp(x) AS sd FROM long GROUP BY "column"
)"""
NUMERIC_COLUMNS = (*PROFILED, "flat", "tenth")


def _correlations() -> str:
    """Pairs of the raw features: the cyclic columns are not rounded before they are correlated."""
    selects = []
    for i, a in enumerate(NUMERIC_COLUMNS):
        for b in NUMERIC_COLUMNS[i + 1:]:
            r = f"corr({a}, {b})"
            flat = f"min({a}) = max({a}) OR min({b}) = max({b}) OR isnan({r})"
            value = f"CASE WHEN {flat} THEN CAST(NULL AS DOUBLE) ELSE round({r}, 6) END"
            selects.append(f"SELECT '{a}' AS x, '{b}' AS y, {value} AS r FROM wide HAVING count(*) > 0")
    return " UNION ALL ".join(selects)


WIDE = """wide AS (
  SELECT max_temp, min_temp, max_power, avg, rng, cdd, hdd, hot, cold, year, month, day, dow, weekend, holiday,
    sin(2 * pi() * dow / 7) AS dow_sin, cos(2 * pi() * dow / 7) AS dow_cos,
    sin(2 * pi() * month / 12) AS mon_sin, cos(2 * pi() * month / 12) AS mon_cos, 1.0::DOUBLE AS flat,
    0.1::DOUBLE AS tenth
  FROM features
)"""
SPIKED = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "max_temp", "min_temp", "spike")
AUTO = f"""{OBS},
spiked AS (SELECT *, CASE WHEN l_orderkey = 7 THEN 10000.0 ELSE max_temp END AS spike FROM obs),
long AS ({" UNION ALL ".join(f"""SELECT '{c}' AS "column", CAST({c} AS DOUBLE) AS x FROM spiked""" for c in SPIKED)}),
sized AS (
  SELECT "column", min(x) AS lo, max(x) AS hi,
    CAST(ceil((max(x) - min(x)) / least(
      (max(x) - min(x)) / (log2(count(*)) + 1),
      2 * (quantile_cont(x, 0.75) - quantile_cont(x, 0.25)) / cbrt(count(*)))) AS BIGINT) AS k
  FROM long GROUP BY "column"
),
slots AS (
  SELECT "column", lo, (hi - lo) / k AS w,
    CAST(least(floor((x - lo) / ((hi - lo) / k)), k - 1) AS BIGINT) AS bin
  FROM long JOIN sized USING ("column")
)"""


def _with(views: str, select: str) -> str:
    return f"WITH {views.strip()}\n{select}"


OBS_IDS = "l_orderkey, l_linenumber, l_partkey, l_suppkey"

ORACLE: dict[str, str] = {
    "make_features": _with(FEATURES, "SELECT * FROM features"),
    "weather_category": _with(OBS, f"SELECT {OBS_IDS}, date, {category_sql()} AS weather_category FROM obs"),
    "numeric_features": _with(OBS, f"SELECT {OBS_IDS}, date, max_temp, min_temp, {NUMERIC} FROM obs"),
    "calendar_features": _with(f"{OBS},{HOLIDAYS}", f"SELECT {OBS_IDS}, date, {CALENDAR} FROM obs"),
    "merge_power_weather": _with(MERGED, "SELECT date, max_temp, min_temp, weather, max_power FROM merged"),
    "daily_peak": """
        SELECT CAST(ts AS DATE) AS date, CAST(trunc(max(value)) AS BIGINT) AS max_power
        FROM events GROUP BY CAST(ts AS DATE)""",
    "land_if_absent": """
        SELECT CAST(l_shipdate AS DATE) AS dt, count(*) AS n FROM lineitem
        WHERE CAST(l_shipdate AS DATE) NOT IN (SELECT CAST(o_orderdate AS DATE) FROM orders)
        GROUP BY CAST(l_shipdate AS DATE)""",
    "split_by_day": "SELECT CAST(l_shipdate AS DATE) AS dt, count(*) AS n FROM lineitem GROUP BY 1",
    "dynamic_overwrite": _with(MERGED, """SELECT date, max_temp, min_temp, weather,
        CASE WHEN date >= DATE '2001-01-01' THEN max_power + 1 ELSE max_power END AS max_power FROM merged"""),
    "merged_scan": _with(MERGED, "SELECT date, max_temp, min_temp, weather, max_power FROM merged"),
    "zip_member_explode": """
        SELECT DISTINCT CAST(ts AS DATE) AS dt, strftime(ts, '%Y%m%d') ||
          CASE WHEN event_type = 'error' THEN '_broken_usage.csv' ELSE '_power_usage.csv' END AS member FROM events""",
    "power_csv_parse": """
        SELECT CAST(ts AS DATE) AS dt, count(*) AS readings, max(value) AS peak
        FROM events WHERE event_type <> 'error' GROUP BY CAST(ts AS DATE)""",
    "bad_file_report": """
        SELECT DISTINCT strftime(ts, '%Y%m%d') || '_broken_usage.csv' AS source, 'missing column' AS error
        FROM events WHERE event_type = 'error'""",
    "weather_csv_parse": _with(OBS, "SELECT date, max_temp, min_temp, weather FROM obs"),
    "dates_in_keys": "SELECT DISTINCT strftime(o_orderdate, '%Y-%m-%d') AS dt FROM orders",
    "date_from_filename": """
        SELECT DISTINCT strftime(o_orderdate, '%Y%m%d') || '_power_usage.csv' AS name, CAST(o_orderdate AS DATE) AS date
        FROM orders""",
    "date_parse": f"""
        SELECT {OBS_IDS},
          CASE l_linenumber
            WHEN 1 THEN strftime(l_shipdate, '%Y/%-m/%-d') WHEN 2 THEN strftime(l_shipdate, '%Y/%m/%d')
            WHEN 3 THEN strftime(l_shipdate, '%Y%m%d') WHEN 4 THEN strftime(l_shipdate, '%Y-%m-%d')
            WHEN 5 THEN strftime(l_shipdate, '%Y/13/45') WHEN 6 THEN strftime(l_shipdate, '%Y-02-30')
            ELSE 'no date' END AS text,
          CASE WHEN l_linenumber <= 4 THEN CAST(l_shipdate AS DATE) END AS date
        FROM lineitem""",
    "numeric_coerce": f"""
        SELECT {OBS_IDS},
          CASE WHEN l_linenumber <= 2 THEN CAST(l_quantity AS VARCHAR)
            WHEN l_linenumber = 3 THEN ' ' || CAST(l_quantity AS VARCHAR) || ' '
            WHEN l_linenumber = 4 THEN CAST(l_quantity AS VARCHAR) || 'e1'
            WHEN l_linenumber = 5 THEN CAST(l_quantity AS VARCHAR) || 'kW'
            WHEN l_linenumber = 6 THEN CAST(l_quantity AS VARCHAR) || 'd'
            ELSE 'nan' END AS text,
          CASE WHEN l_linenumber <= 3 THEN l_quantity WHEN l_linenumber = 4 THEN l_quantity * 10 END AS value
        FROM lineitem""",
    "unprocessed_dates": """
        SELECT DISTINCT CAST(o_orderdate AS DATE) AS date FROM orders
        WHERE CAST(o_orderdate AS DATE) IN (SELECT CAST(l_shipdate AS DATE) FROM lineitem)
          AND CAST(o_orderdate AS DATE) > DATE '2000-01-01'""",
    "watermark_advance": """
        WITH control AS (
          SELECT CAST(o_custkey AS VARCHAR) AS job_name, max(CAST(o_orderdate AS DATE)) AS old
          FROM orders GROUP BY o_custkey
        ), batch AS (
          SELECT CAST(l_suppkey AS VARCHAR) AS job_name, max(CAST(l_shipdate AS DATE)) AS new
          FROM lineitem GROUP BY l_suppkey
        )
        SELECT job_name,
          CASE WHEN old IS NULL OR new > old THEN new ELSE old END AS last_processed,
          CASE WHEN old IS NULL OR new > old THEN '2003-01-01' ELSE '2002-01-01' END AS updated_on
        FROM control FULL OUTER JOIN batch USING (job_name)""",
    "feature_versions": f"""
        SELECT {OBS_IDS}, CAST(l_shipdate AS DATE) AS date, strftime(l_shipdate, '%Y-%m-%d') AS record_id,
          '2024-12-31T03:00:00Z' AS event_time FROM lineitem""",
    "latest_features": _with(
        LATEST,
        f"SELECT {OBS_IDS}, date, record_id, max_temp, min_temp, {category_sql()} AS weather_category, {NUMERIC} FROM latest",
    ),
    "one_hot": _with(FEATURES, f"SELECT date, {ONE_HOT} FROM features"),
    "one_hot_sparse": f"""
        WITH labels AS (SELECT {OBS_IDS}, concat_ws('-', {OBS_IDS}) AS label FROM lineitem),
        places AS (SELECT label, row_number() OVER (ORDER BY label) - 1 AS place FROM (SELECT DISTINCT label FROM labels))
        SELECT {OBS_IDS}, CAST((SELECT count(*) FROM places) AS INTEGER) AS size, CAST(place AS INTEGER) AS place,
          CAST(1 AS DOUBLE) AS value FROM labels JOIN places USING (label)""",
    "ordinal_encode": _with(f"""{FEATURES},
        firsts AS (SELECT weather_category, min(date) AS d FROM features GROUP BY weather_category),
        codes AS (SELECT weather_category, row_number() OVER (ORDER BY d, weather_category) AS code FROM firsts)""",
        "SELECT date, code FROM features JOIN codes USING (weather_category)"),
    "train_matrix": _with(FEATURES, f"SELECT {MATRIX}, row_number() OVER (ORDER BY date) - 1 AS position FROM features"),
    "split_by_date": _with(MERGED, """SELECT date, max_power,
        CASE WHEN date < DATE '2000-10-01' THEN 'train' ELSE 'test' END AS split FROM merged"""),
    "split_by_ratio": _with(MERGED, """SELECT date, max_power,
        CASE WHEN row_number() OVER (ORDER BY date) <= floor((SELECT count(*) FROM merged) * 0.8)
          THEN 'train' ELSE 'test' END AS split FROM merged"""),
    "split_by_ratio_area": _with(f"""{OBS},
        numbered AS (SELECT l_suppkey % 10 AS area, date,
          row_number() OVER (PARTITION BY l_suppkey % 10 ORDER BY date) AS rn,
          count(*) OVER (PARTITION BY l_suppkey % 10) AS total FROM obs)""",
        """SELECT area, CASE WHEN rn <= floor(total * 0.8) THEN 'train' ELSE 'test' END AS split, count(*) AS n,
          min(date) AS first_date, max(date) AS last_date FROM numbered GROUP BY 1, 2"""),
    "regression_metrics": _with(ERRORS, f"SELECT {METRIC_SQL.format(d=6)} FROM scored"),
    "regression_metrics_by_month": _with(ERRORS, f"SELECT month, {METRIC_SQL.format(d=6)} FROM scored GROUP BY month"),
    "prediction_extent": _with(ERRORS, """SELECT round(least(min(y), min(p)) * 0.95, 6) AS low,
        round(greatest(max(y), max(p)) * 1.05, 6) AS high FROM scored"""),
    "metrics_json": _with(ERRORS, """SELECT month, '{"regression_metrics":{"mse":{"value":' ||
        to_json(round(avg((y - p) * (y - p)), 3)) || '}}}' AS report FROM scored GROUP BY month"""),
    "quality_gate": _with(ERRORS, """SELECT month, round(avg((y - p) * (y - p)), 6) AS mse,
        'PendingManualApproval' AS status FROM scored GROUP BY month HAVING avg((y - p) * (y - p)) <= 1500000"""),
    "gate_to_registry": _with(ERRORS, """SELECT model_group, version, 'Approved' AS status, mse FROM (
          SELECT left(month, 4) AS model_group, CAST(right(month, 2) AS BIGINT) AS version,
            round(avg((y - p) * (y - p)), 6) AS mse FROM scored GROUP BY month HAVING avg((y - p) * (y - p)) <= 1200000) t
        QUALIFY row_number() OVER (PARTITION BY model_group ORDER BY version DESC) = 1"""),
    "score_columns_at_hand": _with(MERGED, "SELECT date, true AS same FROM merged"),
    "date_extent": _with(MERGED, "SELECT min(date) AS first_date, max(date) AS last_date FROM merged"),
    "table_profile": _with(MERGED, " UNION ALL ".join(
        f"SELECT CAST({i} AS INTEGER) AS position, '{c}' AS \"column\", count(*) AS rows, count({c}) AS non_null FROM merged"
        for i, c in enumerate(("date", "max_temp", "min_temp", "weather", "max_power"))
    )),
    "category_counts": _with(FEATURES, "SELECT weather_category, count(*) AS n FROM features GROUP BY weather_category"),
    "distinct_weather": _with(MERGED, "SELECT DISTINCT weather FROM merged"),
    "correlation_pairs": _with(f"{FEATURES}, {WIDE}", _correlations()),
    "feature_histogram": _with(f"{FEATURES}, {WIDE}, long AS ({LONG}), {STATS}" + """, held AS (
          SELECT "column", CAST(least(floor((x - lo) / ((hi - lo) / 10)), 9) AS BIGINT) AS bin, count(*) AS n
          FROM long JOIN stats USING ("column") GROUP BY 1, 2
        ), bins AS (SELECT "column", i AS bin, lo, (hi - lo) / 10 AS w FROM stats, generate_series(0, 9) AS g(i))""", """
        SELECT "column", bin, round(lo + bin * w, 6) AS lower, round(lo + (bin + 1) * w, 6) AS upper,
          coalesce(n, 0) AS n FROM bins LEFT JOIN held USING ("column", bin)"""),
    "histogram_auto": _with(AUTO, """
        SELECT s."column", i AS bin, round(s.lo + i * (hi - s.lo) / k, 6) AS lower,
          round(s.lo + (i + 1) * (hi - s.lo) / k, 6) AS upper, count(bin) AS n
        FROM (SELECT *, unnest(range(k)) AS i FROM sized) s
        LEFT JOIN slots t ON t."column" = s."column" AND t.bin = s.i GROUP BY s."column", i, s.lo, hi, k"""),
    "feature_kde": _with(f"""{FEATURES}, {WIDE}, long AS ({LONG}), {STATS},
        grid AS (SELECT "column", CAST(i AS INTEGER) AS point, lo + i * (hi - lo) / 199 AS spot, n,
          sd * pow(n, -0.2) AS h FROM stats, generate_series(0, 199) AS g(i))""", """
        SELECT "column", point, round(min(spot), 6) AS x,
          round(sum(exp(-0.5 * pow((long.x - spot) / h, 2))) / (min(n) * min(h) * sqrt(2 * pi())), 9) AS density
        FROM long JOIN grid USING ("column") GROUP BY "column", point"""),
    "rebuild_date": _with(MERGED, """SELECT CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month,
        CAST(day(date) AS INTEGER) AS day, max_power, date FROM merged"""),
    "parse_requests": _with(MERGED, """
        SELECT strftime(date, '%Y-%m-%d') AS request_id, CAST(i AS INTEGER) AS row_no, date, max_temp, min_temp,
          CASE WHEN i = 1 AND isodow(date) = 1 THEN '晴,' || chr(10) || '"後" 曇' ELSE weather END AS weather,
          CAST(NULL AS VARCHAR) AS error
        FROM weather_daily, generate_series(0, 1) AS g(i) WHERE isodow(date) <= 4 AND (i = 0 OR isodow(date) <= 2)
        UNION ALL
        SELECT strftime(date, '%Y-%m-%d'), NULL, NULL, NULL, NULL, NULL,
          CASE isodow(date) WHEN 5 THEN 'no rows' WHEN 6 THEN 'unsupported content type' ELSE 'missing column' END
        FROM weather_daily WHERE isodow(date) >= 5"""),
    "format_predictions": _with(ERRORS, """
        SELECT month AS request_id,
          CASE WHEN CAST(right(month, 2) AS INTEGER) % 2 = 0
            THEN string_agg(CAST(p AS VARCHAR), chr(10) ORDER BY date) || chr(10)
            ELSE '{"predictions":[' || string_agg(CAST(p AS VARCHAR), ',' ORDER BY date) || ']}' END AS body,
          CASE WHEN CAST(right(month, 2) AS INTEGER) % 2 = 0 THEN 'text/csv' ELSE 'application/json' END AS content_type
        FROM scored GROUP BY month"""),
    "latest_approved": """
        SELECT model_group, version, status, created FROM (
          SELECT 'group-' || CAST(o_custkey AS VARCHAR) AS model_group, o_orderkey AS version, 'Approved' AS status,
            CAST(o_orderdate AS DATE) AS created,
            row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
          FROM orders WHERE o_orderstatus = 'F') t WHERE rn = 1""",
    "stream_daily_peak": """
        SELECT CAST(ts AS DATE) AS date, CAST(trunc(max(value)) AS BIGINT) AS max_power FROM events
        WHERE CAST(ts AS DATE) < (SELECT max(CAST(ts AS DATE)) FROM events) GROUP BY CAST(ts AS DATE)""",
    "stream_features": _with(FEATURES, "SELECT * FROM features"),
    "daily_merge_from_raw": _with(MERGED, "SELECT date, max_temp, min_temp, weather, max_power FROM merged"),
    "stream_late_peaks": """
        WITH tops AS (SELECT CAST(ts AS DATE) AS date, max(value) AS top FROM events GROUP BY 1),
        marked AS (SELECT ts, CAST(ts AS DATE) AS date, value, value = top AS late FROM events JOIN tops
          ON CAST(ts AS DATE) = tops.date),
        reach AS (SELECT max(ts) FILTER (WHERE NOT late) - INTERVAL 10 DAY AS gone, max(ts) AS newest FROM marked),
        days AS (
          SELECT date, date + INTERVAL 1 DAY <= gone AS shut,
            CAST(trunc(max(value)) AS BIGINT) AS whole, CAST(trunc(max(value) FILTER (WHERE NOT late)) AS BIGINT) AS early,
            count(*) FILTER (WHERE late) AS n FROM marked, reach WHERE date + INTERVAL 1 DAY <= newest GROUP BY date, gone
        )
        SELECT date, CASE WHEN shut THEN early ELSE whole END AS max_power,
          CAST(CASE WHEN shut THEN n ELSE 0 END AS BIGINT) AS refused FROM days""",
    "stream_new_files": "SELECT CAST(ts AS DATE) AS dt, CAST(1 AS BIGINT) AS members FROM events GROUP BY CAST(ts AS DATE)",
}
