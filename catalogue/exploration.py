"""Exploration tables."""

from __future__ import annotations

from catalogue import query
from catalogue.base import daily, daily_parts, dealt_daily, grid, hourly, naive, plain, r, sql, table, view
from pyspark.sql import functions as F
from tidewatch.operators import explore as e
from tidewatch.operators.grid import over_parts, regularise
from tidewatch.operators.metrics import residual_histogram
from tidewatch.functions.scalar import _CENTRE, _FAR, _NEAR
from tidewatch.operators.quantiles import exact_quantiles
from tidewatch.operators.split import head, tail
from tidewatch.schemas import DAILY, HOURLY


def stats_sql(t: str) -> str:
    two = lambda e, k=2: r(f"round({e}, {k})")
    return f"""SELECT series, count(demand) AS n_observations, min(timestamp) AS start_date, max(timestamp) AS end_date,
  {two('avg(demand)')} AS mean, {two('stddev_samp(demand)')} AS std, {two('min(demand)')} AS min, {two('max(demand)')} AS max,
  {two('median(demand)')} AS median, {two('skewness(demand)', 4)} AS skewness, {two('kurtosis(demand)', 4)} AS kurtosis,
  {two('avg((demand IS NULL)::INT) * 100', 3)} AS pct_missing FROM {t} GROUP BY 1"""


@query("summary_stats", sql(stats_sql("g_near"), "g"))
def summary_stats(spark, d):
    """Of the unfilled grid, so that the share missing is not 0."""
    return e.summary_stats(regularise(hourly(spark, d)))


@query("summary_stats_daily", sql(stats_sql("lg_near"), "lg"))
def summary_stats_daily(spark, d):
    return e.summary_stats(regularise(daily(spark, d), DAILY), DAILY)


@query("daily_range", sql(f"""SELECT series, date_trunc('day', timestamp)::TIMESTAMP AS timestamp, {r('min(demand)')} AS day_min,
  {r('max(demand)')} AS day_max, {r('avg(demand)')} AS day_mean FROM g GROUP BY 1, 2""", "g"))
def daily_range(spark, d):
    return e.daily_range(plain(spark, d))


def _pivot(names) -> str:
    return ", ".join(r(f"avg(demand) FILTER (dayname(timestamp) = '{n}')") + f' AS "{n}"' for n in names)


@query("hour_weekday_pivot", sql(f"SELECT series, hour(timestamp) AS hour, {_pivot(e.WEEKDAYS)} FROM g GROUP BY 1, 2", "g"))
def hour_weekday_pivot(spark, d):
    return e.hour_weekday_pivot(plain(spark, d))


@query("hour_weekday_pivot_alphabetic", sql(f"SELECT series, hour(timestamp) AS hour, {_pivot(sorted(e.WEEKDAYS))} FROM g GROUP BY 1, 2", "g"))
def hour_weekday_alphabetic(spark, d):
    return e.hour_weekday_pivot(plain(spark, d), alphabetic=True)


@query("weekday_profile", sql(f"SELECT series, isodow(timestamp) - 1 AS day_of_week, hour(timestamp) AS hour, {r('avg(demand)')} AS mean_demand FROM g GROUP BY ALL", "g"))
def weekday_profile(spark, d):
    return e.weekday_profile(plain(spark, d))


def box_sql(t: str, by: str) -> str:
    return f"""SELECT {by}, {r('q1')} AS q1, {r('median')} AS median, {r('q3')} AS q3,
  {r('least(min(demand) FILTER (demand >= q1 - 1.5 * (q3 - q1)), q1)')} AS whisker_low,
  {r('greatest(max(demand) FILTER (demand <= q3 + 1.5 * (q3 - q1)), q3)')} AS whisker_high,
  count(*) FILTER (demand < q1 - 1.5 * (q3 - q1) OR demand > q3 + 1.5 * (q3 - q1)) AS n_outliers, count(*) AS n
FROM {t} JOIN (SELECT {by}, quantile_cont(demand, 0.25) AS q1, median(demand) AS median, quantile_cont(demand, 0.75) AS q3
  FROM {t} GROUP BY ALL) USING ({by}) GROUP BY {by}, q1, median, q3"""


@query("box_stats", sql(box_sql("g", "series"), "g"))
def box_stats(spark, d):
    return e.box_stats(plain(spark, d))


view("lmonth", "lmonth AS (SELECT *, month(timestamp) AS month, strftime(timestamp, '%b') AS month_name FROM lg)", "lg")


@query("monthly_box", sql(box_sql("lmonth", "series, month, month_name"), "lmonth"))
def monthly_box(spark, d):
    return over_parts(daily_parts(spark, d), e.monthly_box)


@query("quantiles_by_flag", f"""SELECT l_returnflag, {r('quantile_cont(l_extendedprice, 0.01)')} AS p01, {r('quantile_cont(l_extendedprice, 0.5)')} AS p50,
  {r('quantile_cont(l_extendedprice, 0.999)')} AS p999, {r('max(l_extendedprice)')} AS p100 FROM lineitem GROUP BY 1""")
def quantiles_by_flag(spark, d):
    """Exact quantiles of few, very long groups."""
    li = table(spark, d, "lineitem")
    return exact_quantiles(li, ["l_returnflag"], "l_extendedprice", {"p01": 0.01, "p50": 0.5, "p999": 0.999, "p100": 1.0})


def hist_sql(t: str, v: str, bins: int) -> str:
    return f"""SELECT series, bin, {r(f'lo + bin * ((hi - lo) / {bins})')} AS bin_start, {r(f'lo + (bin + 1) * ((hi - lo) / {bins})')} AS bin_end,
  coalesce(c, 0) AS count
FROM (SELECT series, lo, hi, unnest(range({bins})) AS bin FROM (SELECT series, min({v}) AS lo, max({v}) AS hi FROM {t} GROUP BY 1))
LEFT JOIN (SELECT series, least(floor(({v} - lo) / ((hi - lo) / {bins})), {bins - 1})::BIGINT AS bin, count(*) AS c
  FROM {t} JOIN (SELECT series, min({v}) AS lo, max({v}) AS hi FROM {t} GROUP BY 1) USING (series) GROUP BY 1, 2) USING (series, bin)"""


@query("histogram80", sql(hist_sql("g", "demand", 80), "g"))
def histogram80(spark, d):
    return e.histogram(plain(spark, d))


view("resid", "resid AS (SELECT series, actual - predicted AS residual FROM p)", "p")


@query("residual_histogram", sql(hist_sql("resid", "residual", 60), "resid"))
def residual_hist(spark, d):
    return residual_histogram(naive(spark, d))


@query("kde", sql(f"""SELECT series, point, {r('max(x)')} AS x, {r('sum(exp(-0.5 * ((x - demand) / h) * ((x - demand) / h)) / (n * h * sqrt(2 * pi())))')} AS density
FROM (SELECT g.series, point, lo + (hi - lo) / 199 * point AS x, demand, h, k.n FROM g
  JOIN (SELECT series, min(demand) AS lo, max(demand) AS hi, count(*) AS n, stddev_samp(demand) * pow(count(*), -0.2) AS h FROM g GROUP BY 1) k USING (series),
  (SELECT unnest(range(200)) AS point)) GROUP BY 1, 2""", "g"))
def kde(spark, d):
    return e.kde(plain(spark, d))


def _poly(table, x: str) -> str:
    """A polynomial, highest power first, in Horner's form."""
    out = repr(table[0]) + "::DOUBLE"
    for c in table[1:]:
        out = f"({out} * {x} + {c!r}::DOUBLE)"
    return out


def _ratio_sql(tables, x: str) -> str:
    return f"({_poly(tables[0], x)} / {_poly(tables[1], x)})"


def normal_quantile_sql(p: str) -> str:
    """AS 241 over the coefficients the library holds."""
    tail = f"sqrt(-ln(CASE WHEN {p} < 0.5 THEN {p} ELSE 1.0 - {p} END))"
    outer = f"CASE WHEN {tail} <= 5 THEN {_ratio_sql(_NEAR, f'({tail} - 1.6)')} ELSE {_ratio_sql(_FAR, f'({tail} - 5.0)')} END"
    return f"CASE WHEN abs({p} - 0.5) <= 0.425 THEN ({p} - 0.5) * {_ratio_sql(_CENTRE, f'(0.180625::DOUBLE - ({p} - 0.5) * ({p} - 0.5))')} WHEN {p} < 0.5 THEN -({outer}) ELSE {outer} END"


view("qq", """qq AS (SELECT series, demand, CASE WHEN i = n THEN pow(0.5::DOUBLE, 1 / n) WHEN i = 1 THEN 1 - pow(0.5::DOUBLE, 1 / n) ELSE (i - 0.3175::DOUBLE) / (n + 0.365::DOUBLE) END AS p FROM (
  SELECT series, demand, row_number() OVER (PARTITION BY series ORDER BY demand) AS i, count(*) OVER (PARTITION BY series)::DOUBLE AS n FROM g))""", "g")


@query("qq_fit", sql(f"""SELECT series, {r('regr_slope(demand, x)')} AS slope, {r('regr_intercept(demand, x)')} AS intercept, {r('regr_r2(demand, x)')} AS r2
  FROM (SELECT series, demand, {normal_quantile_sql('p')} AS x FROM qq) GROUP BY 1""", "qq"))
def qq_fit(spark, d):
    return e.qq_fit(plain(spark, d))


# ------------------------------------------------------------ rolling views

def full(n: int, what: str, order: str = "timestamp", v: str = "demand") -> str:
    frame = f"(PARTITION BY series ORDER BY {order} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    return f"CASE WHEN count({v}) OVER {frame} = {n} THEN {what}({v}) OVER {frame} END"


@query("rolling_overview", sql(f"SELECT series, timestamp, {r('demand')} AS demand, {r('m')} AS rolling_mean_168 FROM (SELECT *, {full(168, 'avg')} AS m FROM g)", "g"))
def rolling_overview(spark, d):
    return e.rolling_overview(plain(spark, d))


view("six", "six AS (SELECT series, time_bucket(INTERVAL 6 HOURS, timestamp) AS timestamp, avg(demand) AS demand FROM u GROUP BY 1, 2)", "u")


@query("rolling_6h", sql(f"""SELECT series, timestamp, {r('demand')} AS demand, {r('a')} AS rolling_mean_16, {r('b')} AS rolling_mean_72, {r('c')} AS rolling_std_16
  FROM (SELECT *, {full(16, 'avg')} AS a, {full(72, 'avg')} AS b, {full(16, 'stddev_samp')} AS c FROM six)""", "six"))
def rolling_6h(spark, d):
    """Narrower widths on the sparse user panel: windows run over the non-empty buckets."""
    return e.rolling_buckets(hourly(spark, d, "user_id"), widths=(16, 72))


view("l6", "l6 AS (SELECT series, time_bucket(INTERVAL 6 HOURS, timestamp) AS timestamp, avg(demand) AS demand FROM lg GROUP BY 1, 2)", "lg")


@query("rolling_6h_long", sql(f"""SELECT series, timestamp, {r('demand')} AS demand, {r('a')} AS rolling_mean_168, {r('b')} AS rolling_mean_720, {r('c')} AS rolling_std_168
  FROM (SELECT *, {full(168, 'avg')} AS a, {full(720, 'avg')} AS b, {full(168, 'stddev_samp')} AS c FROM l6)""", "l6"))
def rolling_6h_long(spark, d):
    """The standard widths, on the long daily panel."""
    return e.rolling_buckets(*dealt_daily(spark, d, 720))


# ------------------------------------------------------------ autocorrelation, decomposition

view("centred", """centred AS (SELECT series, demand - avg(demand) OVER (PARTITION BY series) AS x, row_number() OVER (PARTITION BY series ORDER BY pos) AS i,
  count(*) OVER (PARTITION BY series) AS m FROM g)""", "g")
view("acf", """acf AS (SELECT a.series, lag, any_value(a.m) AS m, coalesce(sum(a.x * b.x), 0) / any_value(ss) AS acf
  FROM centred a CROSS JOIN (SELECT unnest(range(73)) AS lag) LEFT JOIN centred b ON a.series = b.series AND b.i = a.i - lag
  JOIN (SELECT series, sum(x * x) AS ss FROM centred GROUP BY 1) t ON t.series = a.series GROUP BY 1, 2)""", "centred")


@query("acf72", sql(f"""SELECT series, lag, {r('acf')} AS acf, {r('acf - half')} AS lower, {r('acf + half')} AS upper FROM (
  SELECT *, CASE WHEN lag = 0 THEN 0 ELSE 1.959963984540054::DOUBLE * sqrt((1 + 2 * coalesce(sum(CASE WHEN lag > 0 THEN acf * acf END)
    OVER (PARTITION BY series ORDER BY lag ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / m) END AS half FROM acf)""", "acf"))
def acf72(spark, d):
    return e.acf(grid(spark, d))


# Durbin's recursion, one lag a step
view("durbin", """durbin AS (SELECT series, 0 AS lag, 1::DOUBLE AS pacf, []::DOUBLE[] AS phi, 1::DOUBLE AS err, a, m FROM (SELECT series, list(acf ORDER BY lag) AS a, any_value(m) AS m FROM acf GROUP BY 1)
  UNION ALL
  SELECT series, lag + 1, last, list_append(list_transform(range(1, lag + 1), lambda i: phi[i] - last * phi[lag + 1 - i]), last), err * (1 - last * last), a, m
  FROM (SELECT *, (a[lag + 2] - coalesce(list_sum(list_transform(range(1, lag + 1), lambda i: phi[i] * a[lag + 2 - i])), 0)) / err AS last FROM durbin WHERE lag < 72))""", "acf")


@query("pacf72", sql(f"""SELECT series, lag, {r('pacf')} AS pacf, {r('pacf - half')} AS lower, {r('pacf + half')} AS upper FROM (
  SELECT *, CASE WHEN lag = 0 THEN 0 ELSE 1.959963984540054::DOUBLE / sqrt(m) END AS half FROM durbin)""", "durbin").replace("WITH", "WITH RECURSIVE", 1))
def pacf72(spark, d):
    return e.pacf(grid(spark, d))


view("trend0", """trend0 AS (SELECT *, CASE WHEN pos BETWEEN 84 AND n - 85 THEN
    (sum(demand) OVER (PARTITION BY series ORDER BY pos ROWS BETWEEN 84 PRECEDING AND 83 FOLLOWING)
   + sum(demand) OVER (PARTITION BY series ORDER BY pos ROWS BETWEEN 83 PRECEDING AND 84 FOLLOWING)) / 336 END AS t FROM g WHERE n >= 336)""", "g")
view("trend1", """trend1 AS (SELECT series, timestamp, demand, pos, CASE WHEN pos < 84 THEN fs * pos + fi WHEN pos > n - 85 THEN bs * pos + bi ELSE t END AS trend
  FROM trend0 JOIN (SELECT series,
    regr_slope(t, pos) FILTER (pos >= 84 AND pos < least(252, n - 85)) AS fs, regr_intercept(t, pos) FILTER (pos >= 84 AND pos < least(252, n - 85)) AS fi,
    regr_slope(t, pos) FILTER (pos >= greatest(84, n - 253) AND pos < n - 85) AS bs, regr_intercept(t, pos) FILTER (pos >= greatest(84, n - 253) AND pos < n - 85) AS bi
    FROM trend0 GROUP BY 1) USING (series))""", "trend0")


@query("seasonal_decompose", sql(f"""SELECT series, timestamp, {r('demand')} AS observed, {r('trend')} AS trend, {r('s')} AS seasonal, {r('demand - trend - s')} AS residual
FROM trend1 JOIN (SELECT series, ph, m - avg(m) OVER (PARTITION BY series) AS s FROM
  (SELECT series, pos % 168 AS ph, avg(demand - trend) AS m FROM trend1 GROUP BY 1, 2)) k ON k.series = trend1.series AND k.ph = trend1.pos % 168""".replace(
    "SELECT series, timestamp, ", "SELECT trend1.series, timestamp, ", 1), "trend1"))
def decompose(spark, d):
    return e.seasonal_decompose(grid(spark, d))


@query("tail_sample", sql(f"SELECT series, timestamp, {r('demand')} AS demand FROM g WHERE pos >= n - 100", "g"))
def tail_sample(spark, d):
    return tail(grid(spark, d), HOURLY, 100).drop("pos", "n")


@query("tail_sample_sparse", sql(f"SELECT series, timestamp, {r('demand')} AS demand FROM u QUALIFY row_number() OVER (PARTITION BY series ORDER BY timestamp DESC) <= 20", "u"))
def tail_sample_sparse(spark, d):
    return tail(hourly(spark, d, "user_id"), HOURLY, 20).drop("pos", "n")


@query("head_sample", sql(f"SELECT series, timestamp, {r('actual')} AS actual, {r('predicted')} AS predicted FROM p QUALIFY row_number() OVER (PARTITION BY series ORDER BY timestamp) <= 500", "p"))
def head_sample(spark, d):
    return head(naive(spark, d), HOURLY.on(value="actual"), 500)


@query("profile_by_user", sql(f"SELECT series, {r('avg(demand)')} AS mean_demand, count(*) AS n FROM ug GROUP BY 1", "ug"))
def profile_by_user(spark, d):
    return plain(spark, d, "user_id").groupBy("series").agg(F.avg("demand").alias("mean_demand"), F.count(F.lit(1)).alias("n"))
