"""Indicators and dashboard figures."""

from oracle.customers import SQL as CUSTOMERS
from oracle.prelude import cavg, money, pct, ptile, rdiv
from oracle.restaurants import health
from oracle.views import DAILY, DEMAND, PARTPERF, RFM


def revenue(keys: str, source: str = "ord", where: str = "true") -> str:
    group = "GROUP BY ALL" if keys else ""
    lead = keys + ", " if keys else ""
    net = "(coalesce(sum(total_c) FILTER (WHERE NOT can),0) - coalesce(sum(refund_c) FILTER (WHERE NOT can),0))"
    gmv = "sum(total_c) FILTER (WHERE NOT can)"
    return f"""SELECT {lead}count(*) AS orders, count_if(dlv)::BIGINT AS delivered_orders, {money(gmv)} AS gmv, {money(net)} AS net_revenue, {money('sum(comm_c) FILTER (WHERE dlv)')} AS platform_revenue,
 {pct('sum(comm_c) FILTER (WHERE dlv)', gmv, 2)} AS take_rate_pct, {rdiv(net, 'count_if(dlv)*100', 2)} AS aov, {pct('sum(disc_c) FILTER (WHERE NOT can)', gmv, 2)} AS discount_rate_pct, {pct('sum(refund_c)', net, 2)} AS refund_rate_pct
FROM {source} WHERE {where} {group}"""


CITY = "ord JOIN (SELECT cid, city_id FROM cust) USING (cid) JOIN city USING (city_id)"
REST = "ord JOIN (SELECT rid, restaurant_name, cuisine_type FROM rest) USING (rid)"
SPEND = ", per AS (SELECT cid, count(*) AS n, sum(total_c) AS c FROM ord WHERE dlv GROUP BY cid)"

SQL = {
    "k1_revenue_metrics": revenue(""),
    "k13_revenue_by_day": revenue("d AS period"),
    "k13_revenue_by_week_payment": revenue("date_trunc('week', d)::DATE AS period, pay AS payment_method"),
    "k13_revenue_by_month_city": revenue("m AS period, city_name AS city", CITY),
    "k13_revenue_by_month_cuisine": revenue("m AS period, cuisine_type AS cuisine", REST),
    "k13_revenue_ytd_restaurant": revenue("restaurant_name AS restaurant, rid AS restaurant_id", REST, "d>=DATE '2001-01-01'"),
    "k2_customer_metrics": SPEND + f""", f AS (SELECT cid, min(m) AS c0 FROM ord WHERE dlv GROUP BY cid), a AS (SELECT count(DISTINCT cid) AS s FROM f WHERE c0<DATE '2001-07-01'),
 b AS (SELECT count(DISTINCT cid) AS r FROM ord JOIN f USING (cid) WHERE dlv AND c0<DATE '2001-07-01' AND m=c0+INTERVAL 1 MONTH), u AS (SELECT count(DISTINCT cid) AS mau FROM ord WHERE d>=DATE '2001-07-03')
SELECT any_value(mau) AS mau, {pct('any_value(r)', 'any_value(s)', 1)} AS retention_m1_pct, {pct('any_value(s)-any_value(r)', 'any_value(s)', 1)} AS churn_rate_pct, {cavg('c')} AS avg_customer_ltv, {pct('count_if(n>=2)', 'count(*)', 1)} AS repeat_purchase_rate_pct FROM per, a, b, u""",
    "k3_acquisition_cost": SPEND + f""", g AS (SELECT acquisition_channel, count(*) AS k, sum(c) AS l, count(c) AS o FROM cust LEFT JOIN per USING (cid) GROUP BY 1)
SELECT acquisition_channel, k AS new_customers, (k*250)::DOUBLE AS marketing_spend, {rdiv('k*250', 'k', 2)} AS cac, {rdiv('l', 'o*100', 2)} AS avg_ltv, {rdiv('l*k', 'k*250*o*100', 2)} AS ltv_to_cac FROM g""",
    "k4_delivery_metrics": f""", t AS (SELECT {rdiv('sum(mins)', 'count(mins)', 1)} AS avg_delivery_mins, {ptile('mins', 50, 1)} AS median_delivery_mins, {pct('count_if(breached)', 'count(*)', 2)} AS sla_breach_rate_pct, {pct('count_if(on_time)', 'count(*)', 2)} AS on_time_rate_pct FROM dl WHERE done),
 u AS (SELECT {rdiv('sum(n)', 'count(*)', 2)} AS partner_utilisation FROM (SELECT count(*) AS n FROM dl JOIN (SELECT oid, d FROM ord) USING (oid) WHERE done GROUP BY partner_id, d)), c AS (SELECT {pct('count_if(can)', 'count(*)', 2)} AS cancellation_rate_pct FROM ord) SELECT * FROM t, u, c""",
    "k5_restaurant_metrics": f""", q AS (SELECT rid, d, row_number() OVER (PARTITION BY rid ORDER BY ts, oid) AS k FROM ord WHERE dlv), r AS (SELECT {rdiv("sum(datediff('day', joining_date, d))", 'count(*)', 1)} AS avg_days_to_100_orders FROM q JOIN rest USING (rid) WHERE k=100),
 f AS (SELECT {rdiv('sum(food)', 'count(food)', 2)} AS avg_food_rating FROM rv), o AS (SELECT {cavg('total_c')} AS avg_order_value FROM ord WHERE NOT can), a AS (SELECT {pct("(SELECT count(DISTINCT rid) FROM ord WHERE d>=DATE '2001-07-03')", '(SELECT count(*) FROM rest)', 1)} AS activation_rate_pct) SELECT * FROM r, f, o, a""",
    "k6_ticket_sla": f""", l AS (SELECT *, CASE priority WHEN 'Critical' THEN 2 WHEN 'High' THEN 8 WHEN 'Medium' THEN 24 END AS lim, datediff('second', created_at, resolved_at) AS s FROM tk)
SELECT priority, max(lim) AS sla_hours, count(*) AS tickets, count(s) AS resolved, count_if(coalesce(s>lim*3600,false))::BIGINT AS breaches, {pct('count_if(coalesce(s>lim*3600,false))', 'count(s)', 1)} AS breach_pct FROM l GROUP BY 1""",
    "k6_assignment_sla": f""", a AS (SELECT datediff('second', ts, assigned_at) AS s FROM dl JOIN (SELECT oid, ts FROM ord) USING (oid))
SELECT count(s) AS assigned, {rdiv('sum(s)', 'count(s)*60', 2)} AS avg_assignment_mins, count_if(s<180)::BIGINT AS within_target, {pct('count_if(s<180)', 'count(s)', 1)} AS within_target_pct, count_if(s>300)::BIGINT AS breaches, {pct('count_if(s>300)', 'count(s)', 1)} AS breach_pct FROM a""",
    "k7_rfm_by_dictionary": RFM + f""", g AS (SELECT *, CASE WHEN least(r_score,f_score,m_score)>=4 THEN 'Champions' WHEN least(r_score,f_score)>=3 THEN 'Loyal' WHEN r_score=5 AND f_score=1 THEN 'New Customer' WHEN r_score>=4 AND f_score<=2 THEN 'Promising'
 WHEN r_score<=2 AND f_score>=4 THEN 'At Risk' WHEN r_score=1 AND f_score=1 THEN 'Lost' WHEN r_score<=3 AND f_score<=2 THEN 'Hibernating' ELSE 'Needs Attention' END AS s FROM rfm)
SELECT s AS rfm_segment, count(*) AS customers, {cavg('mon_c')} AS avg_ltv, {rdiv('sum(recency_days)', 'count(*)', 0)} AS avg_days_inactive FROM g GROUP BY 1""",
    "k8_month_to_date": DAILY + f""", w AS (SELECT day, date_trunc('month', day)::DATE AS mm, sum(gross_c) OVER (PARTITION BY date_trunc('month', day) ORDER BY day) AS r FROM daily),
 j AS (SELECT a.day, a.r, (SELECT arg_max(b.r, b.day) FROM w b WHERE b.mm=a.mm-INTERVAL 1 MONTH AND b.day<=a.day-INTERVAL 1 MONTH) AS p FROM w a)
SELECT day, {money('r')} AS mtd_gmv, {money('p')} AS prior_mtd_gmv, coalesce({pct('r-p', 'p', 2)},0) AS mom_growth_pct FROM j""",
    "k9_late_share_of_partners": PARTPERF + f" SELECT {pct('sum(sla_breaches)', 'sum(total_deliveries)', 2)} AS sla_breach_pct, {pct('count(sla_breaches)', 'sum(total_deliveries)', 2)} AS published_pct FROM partperf",
    "k9_demand_colors": DEMAND + " SELECT day_of_week, hour_of_day, demand_index, CASE WHEN demand_index>=2 THEN '#E74C3C' WHEN demand_index>=1.5 THEN '#F39C12' ELSE '#27AE60' END AS color FROM demand",
    "k9_tier_colors": " SELECT customer_tier, count(*) AS customers, CASE customer_tier WHEN 'Platinum' THEN '#8E44AD' WHEN 'Gold' THEN '#F39C12' WHEN 'Silver' THEN '#95A5A6' ELSE '#CD6155' END AS color FROM cust GROUP BY 1",
    "k10_best_and_worst_partners": PARTPERF + """, a AS (SELECT partner_id, partner_name, vehicle_type, city_name, on_time_rate_pct FROM partperf WHERE on_time_rate_pct IS NOT NULL), t AS (SELECT *, 'top' AS side FROM a ORDER BY on_time_rate_pct DESC, partner_id LIMIT 20),
 b AS (SELECT *, 'bottom' AS side FROM a ORDER BY on_time_rate_pct, partner_id LIMIT 20) SELECT * FROM t UNION ALL SELECT * FROM b""",
    "k10_trips_per_day_histogram": " SELECT n AS deliveries_that_day, count(*) AS partner_days FROM (SELECT count(*) AS n FROM dl JOIN (SELECT oid, d FROM ord) USING (oid) WHERE done GROUP BY partner_id, d) GROUP BY 1",
    "k10_earnings_by_vehicle": f" SELECT vehicle_type, {money('min(dl.earn_c)')} AS lowest, {ptile('dl.earn_c', 25, 2, 100)} AS q1, {ptile('dl.earn_c', 50, 2, 100)} AS q2, {ptile('dl.earn_c', 75, 2, 100)} AS q3, {money('max(dl.earn_c)')} AS highest FROM dl JOIN prt USING (partner_id) WHERE done GROUP BY 1",
    "k11_zone_alerts": f""", p AS (SELECT zid, count(*) AS n, count_if(breached) AS l, sum(mins) AS s FROM dl JOIN (SELECT oid, zid FROM ord) USING (oid) WHERE done GROUP BY 1), f AS (SELECT zone_id, count(*) AS k FROM prt WHERE is_active AND current_status='Available' GROUP BY 1)
SELECT zone_name, city_name, {pct('l', 'n', 1)} AS sla_breach_pct, {rdiv('s', 'n', 1)} AS avg_mins, target AS target_mins, coalesce(k,0)::BIGINT AS available_partners, coalesce(l*100>n*15,false) AS late_alert, coalesce(s*100>n*target*130,false) AS slow_alert, coalesce(k,0)<5 AS partner_alert
FROM zn JOIN city USING (city_id) LEFT JOIN p ON zid=zn.zone_id LEFT JOIN f ON f.zone_id=zn.zone_id""",
    "k12_value_histogram": SPEND + f""", b AS (SELECT min(c) AS lo, max(c) AS hi FROM per) SELECT (least((c-lo)*50//(hi-lo), 49)+1)::INT AS bin, count(*) AS rows, {money('min(c)')} AS low, {money('max(c)')} AS high FROM per, b GROUP BY 1""",
    "k12_order_value_by_channel": f"SELECT acquisition_channel, count(*) AS orders, {cavg('total_c')} AS aov FROM ord JOIN (SELECT cid, acquisition_channel FROM cust) USING (cid) WHERE dlv GROUP BY 1",
    "k12_rating_trend": f"SELECT rid AS restaurant_id, date_trunc('month', created_at)::DATE AS month, {rdiv('sum(ov)', 'count(ov)', 2)} AS avg_rating, count(ov) AS ratings FROM rv GROUP BY 1, 2",
    "k12_rating_against_orders": f"SELECT rid AS restaurant_id, restaurant_name, {money('rating_c')} AS rating, total_orders FROM rest",
    "k12_health_distribution": health(True).replace("SELECT rid AS restaurant_id", ", hs AS (SELECT rid AS restaurant_id", 1) + ") SELECT (floor(health_score/10)*10)::INT AS score_from, partner_status, count(*) AS restaurants FROM hs GROUP BY 1, 2",
    "i36_segments_with_revenue": CUSTOMERS["cu2_rfm_summary"],
}
