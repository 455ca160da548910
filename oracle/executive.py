"""Platform tiles, trends, unit economics."""

from oracle.prelude import money, pct, rdiv
from oracle.views import DAILY


def tiles(fix: bool) -> str:
    g = pct("u-u0", "u0", 1) if fix else "((u-u0)//nullif(u0,0)*100)::DOUBLE"
    return f""", t AS (SELECT sum(total_c) FILTER (WHERE NOT can) AS g, sum(comm_c) FILTER (WHERE dlv) AS k, count(*) AS n, count_if(dlv) AS e, count_if(can) AS x, count(DISTINCT cid) AS u, count(DISTINCT rid) AS r, sum(disc_c) AS dc
 FROM ord WHERE m=DATE '2001-08-01'), p AS (SELECT sum(total_c) FILTER (WHERE NOT can) AS g0, count(DISTINCT cid) AS u0 FROM ord WHERE m=DATE '2001-07-01')
SELECT 'August 2001' AS period, {money('g')} AS mtd_gmv, {money('k')} AS platform_revenue, {pct('k', 'g', 2)} AS take_rate_pct, n AS total_orders, e::BIGINT AS delivered_orders, x::BIGINT AS cancelled_orders, {pct('x', 'n', 2)} AS cancellation_rate_pct,
 u AS active_customers, r AS active_restaurants, {rdiv('g', 'e*100', 2)} AS avg_order_value, {money('dc')} AS discounts_given, {pct('dc', 'g', 2)} AS discount_rate_pct, {pct('g-g0', 'g0', 1)} AS gmv_mom_growth_pct, {g} AS customer_mom_growth_pct FROM t, p"""


def newret(fix: bool) -> str:
    g = pct("a-p", "p", 1) if fix else "((a-p)//nullif(p,0)*100)::DOUBLE"
    return f""", f AS (SELECT cid, min(m) AS f FROM ord WHERE dlv GROUP BY cid), q AS (SELECT m, count(DISTINCT cid) AS t, count(DISTINCT cid) FILTER (WHERE f=m) AS a, count(DISTINCT cid) FILTER (WHERE f<m) AS b FROM ord JOIN f USING (cid) WHERE dlv GROUP BY m),
 w AS (SELECT *, lag(a) OVER (ORDER BY m) AS p FROM q)
SELECT m AS month, t AS total_active, a AS new_customers, b AS returning_customers, {pct('a', 't', 1)} AS new_pct, {pct('b', 't', 1)} AS returning_pct, p AS prev_new_customers, {g} AS new_customer_growth_pct FROM w ORDER BY m DESC LIMIT 24"""


def dod(fix: bool) -> str:
    g = pct("n-p", "p", 2) if fix else "((n-p)//nullif(p,0)*100)::DOUBLE"
    return f""", q AS (SELECT d, count(*) AS n FROM ord WHERE dlv AND d>=DATE '2001-05-04' GROUP BY d), w AS (SELECT *, lag(n) OVER (ORDER BY d) AS p, sum(n) OVER (ORDER BY d ROWS 6 PRECEDING) AS s, count(*) OVER (ORDER BY d ROWS 6 PRECEDING) AS c FROM q)
SELECT d AS order_date, n AS orders, p AS prev_day_orders, {g} AS dod_growth_pct, {rdiv('s', 'c', 1)} AS ma_7d FROM w"""


SQL = {
    "ex1_month_tiles": tiles(False),
    "ex1_month_tiles_corrected": tiles(True),
    "ex2_gmv_trend": DAILY + f""", w AS (SELECT *, sum(gross_c) OVER (ORDER BY day ROWS UNBOUNDED PRECEDING) AS cum, sum(gross_c) OVER (ORDER BY day ROWS 2 PRECEDING) AS s3, count(*) OVER (ORDER BY day ROWS 2 PRECEDING) AS n3,
 lag(gross_c,12) OVER (ORDER BY day) AS p FROM daily WHERE day>=DATE '1999-08-02' AND day(day)=1)
SELECT day AS month, {money('gross_c')} AS gmv, {money('plat_c')} AS platform_revenue, avg_order_value, total_orders, active_customers, cancellation_rate_pct, {money('cum')} AS cumulative_gmv, {rdiv('s3', 'n3*100', 2)} AS ma_3month_gmv,
 {money('p')} AS same_month_last_year, {pct('gross_c-p', 'p', 1)} AS yoy_growth_pct FROM w""",
    "ex3_unit_economics": f""", a AS (SELECT sum(total_c) FILTER (WHERE dlv) AS g, sum(comm_c) FILTER (WHERE dlv) AS k, sum(disc_c) AS dc, count_if(dlv) AS n, count(DISTINCT cid) AS u, count(DISTINCT rid) AS r FROM ord WHERE d>=DATE '2001-07-03'),
 b AS (SELECT sum(earn_c) AS e FROM dl WHERE done AND delivered_at>=TIMESTAMP '2001-07-03')
SELECT {money('g')} AS net_gmv, {money('k')} AS platform_rev, {money('e')} AS delivery_cost, {money('dc')} AS total_discounts, {money('k-e-dc')} AS contribution_margin, {rdiv('g', 'n*100', 2)} AS avg_order_value, {rdiv('k', 'n*100', 2)} AS revenue_per_order,
 {rdiv('e', 'n*100', 2)} AS delivery_cost_per_order, {rdiv('dc', 'n*100', 2)} AS discount_per_order, {rdiv('k-e-dc', 'n*100', 2)} AS cm_per_order, {pct('k', 'g', 2)} AS take_rate_pct, u AS unique_customers, r AS unique_restaurants FROM a, b""",
    "ex4_new_and_returning": newret(False),
    "ex4_new_and_returning_corrected": newret(True),
    "i18_moving_orders": f""", q AS (SELECT d, count(*) AS n FROM ord WHERE dlv GROUP BY d)
SELECT d AS order_date, n AS daily_orders, {rdiv('sum(n) OVER (ORDER BY d ROWS 6 PRECEDING)', 'count(*) OVER (ORDER BY d ROWS 6 PRECEDING)', 1)} AS ma_7day, {rdiv('sum(n) OVER (ORDER BY d ROWS 29 PRECEDING)', 'count(*) OVER (ORDER BY d ROWS 29 PRECEDING)', 1)} AS ma_30day
FROM q ORDER BY d DESC LIMIT 90""",
    "i18_moving_orders_calendar": f""", q AS (SELECT d, count(*) AS n FROM ord WHERE dlv GROUP BY d), s AS (SELECT unnest(generate_series(min(d), max(d), INTERVAL 1 DAY))::DATE AS d FROM q), f AS (SELECT d, coalesce(n,0) AS n FROM s LEFT JOIN q USING (d))
SELECT d AS order_date, n AS daily_orders, {rdiv('sum(n) OVER (ORDER BY d ROWS 6 PRECEDING)', 'count(*) OVER (ORDER BY d ROWS 6 PRECEDING)', 1)} AS ma_days FROM f""",
    "i20_monthly_growth": f""", q AS (SELECT m, sum(total_c) AS c FROM ord WHERE dlv GROUP BY m), w AS (SELECT *, lag(c) OVER (ORDER BY m) AS p, sum(c) OVER (ORDER BY m ROWS UNBOUNDED PRECEDING) AS cum FROM q)
SELECT m AS month, {money('c')} AS gmv, {money('p')} AS prev_gmv, {pct('c-p', 'p', 1)} AS mom_growth_pct, {money('cum')} AS cumulative_gmv FROM w""",
    "i24_platform_revenue_trend": f""", q AS (SELECT d, sum(comm_c) AS c FROM ord WHERE dlv GROUP BY d), w AS (SELECT *, sum(c) OVER (ORDER BY d ROWS UNBOUNDED PRECEDING) AS a, sum(c) OVER (ORDER BY d ROWS 29 PRECEDING) AS b, lag(c,30) OVER (ORDER BY d) AS p FROM q)
SELECT d AS order_date, {money('c')} AS platform_rev, {money('a')} AS running_total, {money('b')} AS rolling_30d_rev, {money('p')} AS same_day_30d_ago, {pct('c-p', 'p', 1)} AS growth_vs_30d_ago_pct FROM w ORDER BY d DESC LIMIT 60""",
    "i37_daily_growth": dod(False),
    "i37_daily_growth_corrected": dod(True),
    "i43_daily_retention": f""", f AS (SELECT cid, min(m) AS f FROM ord WHERE dlv GROUP BY cid), q AS (SELECT d, count(DISTINCT cid) AS t, count(DISTINCT cid) FILTER (WHERE f<m) AS b FROM ord JOIN f USING (cid) WHERE dlv GROUP BY d),
 w AS (SELECT *, round({pct('b', 't', 10)}*10000000000)::BIGINT AS s FROM q)
SELECT d AS order_date, b AS returning_customers, t AS total_active, {pct('b', 't', 1)} AS retention_rate_pct, {rdiv('sum(s) OVER (ORDER BY d ROWS 29 PRECEDING)', '(count(*) OVER (ORDER BY d ROWS 29 PRECEDING))*10000000000', 1)} AS rolling_30d_retention_pct FROM w ORDER BY d DESC LIMIT 60""",
    "ru1_platform_kpis": f"""SELECT count_if(dlv)::BIGINT AS delivered_orders, count_if(can)::BIGINT AS cancelled_orders, {money('sum(total_c) FILTER (WHERE dlv)')} AS gmv, {rdiv('sum(total_c) FILTER (WHERE dlv)', 'count_if(dlv)*100', 2)} AS aov,
 count(DISTINCT cid) AS unique_customers, count(DISTINCT rid) AS unique_restaurants FROM ord WHERE d>=DATE '2001-07-03'""",
    "nb4_platform_overview": f"""SELECT count_if(dlv)::BIGINT AS delivered, count_if(can)::BIGINT AS cancelled, count(*) AS total_orders, {rdiv('sum(total_c) FILTER (WHERE dlv)', '100', 0)} AS gmv, count(DISTINCT cid) AS customers, count(DISTINCT rid) AS restaurants FROM ord""",
    "nb5_recent_trend": f""", q AS (SELECT d, count(*) AS n, sum(total_c) AS c FROM ord WHERE dlv AND d>=DATE '2001-05-04' GROUP BY d)
SELECT d AS order_date, n AS orders, {money('c')} AS revenue, CASE WHEN row_number() OVER (ORDER BY d)>=7 THEN {rdiv('sum(n) OVER (ORDER BY d ROWS 6 PRECEDING)', '7', 4)} END AS ma7 FROM q""",
    "nb9_month_start_growth": DAILY + f""", q AS (SELECT * FROM daily WHERE day(day)=1 ORDER BY day DESC LIMIT 18), w AS (SELECT *, lag(gross_c) OVER (ORDER BY day) AS p FROM q)
SELECT day, {money('gross_c')} AS gmv, {money('plat_c')} AS platform_revenue, total_orders, active_customers, avg_order_value, {pct('plat_c', 'gross_c', 1)} AS take_rate_pct, {pct('gross_c-p', 'p', 1)} AS mom_growth_pct FROM w""",
}
