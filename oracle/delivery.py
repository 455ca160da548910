"""Delivery times, partners, zones."""

from oracle.prelude import cavg, money, pct, ptile, rdiv
from oracle.views import AS_OF, PARTPERF

TIMES = ", ".join(f"{ptile('mins', p, 0)} AS {n}_mins" for n, p in
                  (("p25", 25), ("median", 50), ("p75", 75), ("p90", 90), ("p95", 95), ("p99", 99)))


def scores(weight: int) -> str:
    return PARTPERF + f""", sc AS (SELECT *, {rdiv(f'''coalesce(rating_c,0)*{weight}*10 + coalesce(round(on_time_rate_pct*10)::BIGINT,0)*30
 + least(25000, total_deliveries*25) + greatest(0, 25000-coalesce(round(avg_delivery_time*10)::BIGINT,400)*100)''', '1000', 1)} AS performance_score,
 ['⚠️  Needs Coaching','📊 Average','✅ Good','🌟 Top Performer'][performance_quartile] AS performance_tier FROM partperf)
SELECT * EXCLUDE (rating_c, joining_date, on_time_deliveries) FROM sc ORDER BY performance_score DESC NULLS LAST, partner_id LIMIT 100"""


def zone_risk(den: str) -> str:
    return f""", z AS (SELECT zid, count(dl.oid) AS n, count(DISTINCT partner_id) AS p, round({rdiv('sum(mins)', 'count(mins)', 1)}*10)::BIGINT AS avg10,
 {ptile('mins', 90, 0)} AS p90, round({pct('count_if(breached)', den, 1)}*10)::BIGINT AS b10
 FROM ord LEFT JOIN (SELECT * FROM dl WHERE done) dl USING (oid) GROUP BY zid HAVING count(dl.oid)>100)
SELECT zone_name, city_name, target AS target_time, n AS total_deliveries, p AS active_partners, avg10::DOUBLE/10 AS actual_avg_time, p90 AS p90_time,
 b10::DOUBLE/10 AS sla_breach_pct, (avg10-target*10)::DOUBLE/10 AS time_vs_target_mins,
 CASE WHEN b10>200 OR avg10*2>target*30 THEN '🚨 High Risk — Increase partner supply' WHEN b10>100 OR avg10*10>target*120 THEN '⚠️  Medium Risk — Monitor closely' ELSE '✅ On Target' END AS zone_risk,
 {rdiv('n', 'p', 1)} AS deliveries_per_partner FROM z JOIN zn ON zone_id=zid JOIN city USING (city_id)"""


SQL = {
    "de1_delivery_times": f"""SELECT {rdiv('sum(mins)', 'count(mins)', 1)} AS mean_mins, {TIMES}, count(*) AS total_deliveries, count_if(breached)::BIGINT AS sla_breaches,
 {pct('count_if(breached)', 'count(*)', 2)} AS sla_breach_pct, count_if(on_time)::BIGINT AS on_time_count, {pct('count_if(on_time)', 'count(*)', 2)} AS on_time_rate_pct FROM dl WHERE done""",
    "de2_delivery_heatmap": f""", c AS (SELECT extract(dow FROM ts)::INT AS day_num, hour(ts)::INT AS hour, min(dayname(ts)) AS day_name, count(*) AS n, sum(mins) AS s,
 {ptile('mins', 50, 0)} AS med, count_if(breached) AS b, round({rdiv('sum(mins)', 'count(*)', 10)}*10000000000)::BIGINT AS a FROM dl JOIN (SELECT oid, ts FROM ord) USING (oid) WHERE done GROUP BY 1, 2)
SELECT day_name, day_num, hour, n AS deliveries, {rdiv('s', 'n', 1)} AS avg_delivery_mins, med AS median_delivery_mins, b::BIGINT AS sla_breaches,
 {pct('b', 'n', 1)} AS sla_breach_pct, {rdiv('a*(SELECT count(*) FROM c)', '(SELECT sum(a) FROM c)', 3)} AS congestion_index FROM c""",
    "de3_partner_scores": scores(20),
    "de3_partner_scores_corrected": scores(4),
    "de4_zone_risk": zone_risk("count(*)"),
    "de4_zone_risk_corrected": zone_risk("count(dl.oid)"),
    "de5_cancellation_reasons": f""", h AS (SELECT reason, hour(ts)::INT AS h, count(*) AS n FROM ord WHERE can AND reason IS NOT NULL GROUP BY 1, 2),
 md AS (SELECT reason, h FROM h QUALIFY row_number() OVER (PARTITION BY reason ORDER BY n DESC, h)=1)
SELECT reason AS cancellation_reason, count(*) AS cancellations, {pct('count(*)', '(SELECT sum(n) FROM h)', 2)} AS pct_of_cancellations, {cavg('total_c')} AS avg_order_value_lost,
 {money('sum(total_c)')} AS total_gmv_lost, {rdiv("sum(datediff('second', ts, cancelled_at))", 'count(cancelled_at)*60', 1)} AS avg_mins_before_cancel, any_value(md.h) AS most_common_cancel_hour
FROM ord JOIN md USING (reason) WHERE can GROUP BY reason""",
    "de6_partner_earnings": f""", pday AS (SELECT partner_id, d, count(*) AS n, sum(earn_c) AS e, sum(km_c) AS k, round({rdiv('sum(mins)', 'count(mins)', 10)}*10000000000)::BIGINT AS a
 FROM dl JOIN (SELECT oid, d FROM ord) USING (oid) WHERE done GROUP BY 1, 2)
SELECT p.partner_id, partner_name, vehicle_type, city_name, count(*) AS working_days, {rdiv('sum(n)', 'count(*)', 1)} AS avg_deliveries_per_day, {money('sum(e)')} AS total_earnings,
 {cavg('e')} AS avg_daily_earnings, {rdiv('sum(k)', '100', 1)} AS total_km, {rdiv('sum(a)', 'count(*)*10000000000', 1)} AS avg_delivery_time, {pct('count_if(n>=8)', 'count(*)', 1)} AS high_util_days_pct
FROM pday JOIN prt p USING (partner_id) JOIN city USING (city_id) WHERE is_active GROUP BY 1,2,3,4 ORDER BY sum(e) DESC, partner_id LIMIT 50""",
    "x2_zone_performance": f"""SELECT zone_name, city_name, count(*) AS total_deliveries, {rdiv('sum(mins)', 'count(mins)', 1)} AS avg_time_mins, {ptile('mins', 50, 1)} AS median_time_mins,
 {pct('count_if(breached)', 'count(*)', 1)} AS sla_breach_pct, {pct('count_if(on_time)', 'count(*)', 1)} AS on_time_pct, {rdiv('sum(km_c)', 'count(km_c)*100', 2)} AS avg_distance_km, {money('sum(earn_c)')} AS total_earnings
FROM dl JOIN (SELECT oid, zid, d FROM ord) USING (oid) JOIN zn ON zone_id=zid JOIN city USING (city_id) WHERE done AND d BETWEEN DATE '2001-07-03' AND {AS_OF} GROUP BY 1, 2""",
    "i8_late_orders": """SELECT oid AS order_id, customer_name, restaurant_name, city_name, zone_name, mins AS actual_time_mins, expected AS expected_time_mins, mins-expected AS overrun_mins
FROM dl JOIN (SELECT oid, cid, rid, zid FROM ord) USING (oid) JOIN (SELECT cid, customer_name FROM cust) USING (cid) JOIN rest USING (rid) JOIN city USING (city_id) LEFT JOIN zn ON zn.zone_id=zid
WHERE breached ORDER BY mins DESC, oid LIMIT 20""",
    "i32_slow_partners": f""", pz AS (SELECT partner_id, zid, count(*) AS n, sum(mins) AS s FROM dl JOIN (SELECT oid, zid FROM ord) USING (oid) WHERE done GROUP BY 1, 2),
 zz AS (SELECT zid, sum(n) AS zn_, sum(s) AS zs FROM pz GROUP BY zid)
SELECT partner_name, vehicle_type, zone_name, {rdiv('s', 'n', 1)} AS partner_avg_mins, {rdiv('zs', 'zn_', 1)} AS zone_avg_mins, {rdiv('s*zn_-zs*n', 'n*zn_', 1)} AS mins_above_zone_avg, n AS deliveries
FROM pz JOIN zz USING (zid) JOIN prt USING (partner_id) JOIN zn ON zn.zone_id=zid WHERE n>=20 AND s*zn_*10>zs*n*13""",
    "i32_slow_partners_105": f""", pz AS (SELECT partner_id, zid, count(*) AS n, sum(mins) AS s FROM dl JOIN (SELECT oid, zid FROM ord) USING (oid) WHERE done GROUP BY 1, 2),
 zz AS (SELECT zid, sum(n) AS zn_, sum(s) AS zs FROM pz GROUP BY zid)
SELECT partner_name, vehicle_type, zone_name, {rdiv('s', 'n', 1)} AS partner_avg_mins, {rdiv('zs', 'zn_', 1)} AS zone_avg_mins, {rdiv('s*zn_-zs*n', 'n*zn_', 1)} AS mins_above_zone_avg, n AS deliveries
FROM pz JOIN zz USING (zid) JOIN prt USING (partner_id) JOIN zn ON zn.zone_id=zid WHERE n>=20 AND s*zn_*100>zs*n*105""",
    "i41_inactive_partners": f""", la AS (SELECT partner_id, max(delivered_at)::DATE AS l FROM dl WHERE done GROUP BY 1), z AS (SELECT *, datediff('day', l, {AS_OF})::INT AS i FROM prt LEFT JOIN la USING (partner_id) WHERE is_active)
SELECT partner_name, vehicle_type, city_name, joining_date, l AS last_active_date, i AS days_inactive, total_deliveries, CASE WHEN i>60 THEN 'Churned' WHEN i>30 THEN 'At Risk' ELSE 'Active' END AS partner_status
FROM z JOIN city USING (city_id) WHERE i IS NULL OR i>30""",
    "i44_slow_zones": f""", zz AS (SELECT zid, sum(mins)::DOUBLE/count(mins) AS a, {rdiv('sum(mins)', 'count(mins)', 1)} AS avg_mins, {rdiv('sum(km_c)', 'count(km_c)*100', 2)} AS avg_km, count(*) AS deliveries
 FROM dl JOIN (SELECT oid, zid FROM ord) USING (oid) WHERE done GROUP BY zid)
SELECT zone_name, city_name, avg_mins, avg_km, deliveries, rank() OVER (PARTITION BY city_name ORDER BY a DESC)::INT AS slow_rank FROM zz JOIN zn ON zone_id=zid JOIN city USING (city_id) ORDER BY a DESC, zid LIMIT 20""",
    "i45_unassigned_risk": f"""SELECT count(*) AS unassigned_active_orders, {money('sum(total_c)')} AS gmv_at_risk, zone_name, city_name FROM ord LEFT JOIN zn ON zone_id=zid LEFT JOIN city USING (city_id)
WHERE st='On The Way' AND oid NOT IN (SELECT oid FROM dl) GROUP BY zone_name, city_name""",
    "nb11_late_share": f"SELECT {pct('count_if(breached)', 'count(*)', 1)} AS sla_breach_pct FROM dl WHERE done",
    "nb12_time_percentiles": "SELECT " + ", ".join(f"{ptile('mins', p, 1)} AS p{p}" for p in (10, 25, 50, 75, 90, 95, 99)) +
        f", {pct('count_if(mins>45)', 'count(*)', 1)} AS late_pct, count(*) AS deliveries FROM dl WHERE done AND mins<120",
    "nb12_time_histogram": """, v AS (SELECT mins FROM dl WHERE done AND mins<120), b AS (SELECT min(mins) AS lo, max(mins) AS hi FROM v)
SELECT (least((mins-lo)*50//greatest(hi-lo,1), 49)+1)::INT AS bin, count(*) AS rows, min(mins) AS low, max(mins) AS high FROM v, b GROUP BY 1""",
    "nb13_zone_late_share": f"""SELECT zone_name, city_name, count(*) AS deliveries, {rdiv('sum(mins)', 'count(mins)', 1)} AS avg_time, {pct('count_if(breached)', 'count(*)', 1)} AS sla_pct
FROM dl JOIN (SELECT oid, zid FROM ord) USING (oid) JOIN zn ON zone_id=zid JOIN city USING (city_id) WHERE done GROUP BY 1, 2 HAVING count(*)>50 ORDER BY sla_pct DESC, zone_name, city_name LIMIT 20""",
    "nb14_quartile_by_vehicle": PARTPERF + f""" SELECT performance_quartile, vehicle_type, count(*) AS partners, {rdiv('sum(round(avg_delivery_time*10)::BIGINT)', 'count(avg_delivery_time)*10', 1)} AS avg_mins,
 {rdiv('sum(round(on_time_rate_pct*10)::BIGINT)', 'count(on_time_rate_pct)*10', 1)} AS avg_on_time_pct, {rdiv('sum(round(total_earnings*100)::BIGINT)', 'count(total_earnings)*100', 0)} AS avg_earnings FROM partperf GROUP BY 1, 2""",
    "nb14_quartile_pivot": PARTPERF + f""", q AS (SELECT performance_quartile, vehicle_type, {rdiv('sum(round(on_time_rate_pct*10)::BIGINT)', 'count(on_time_rate_pct)*10', 1)} AS v FROM partperf GROUP BY 1, 2)
SELECT performance_quartile, """ + ", ".join(f"max(v) FILTER (WHERE vehicle_type='{v}') AS \"{v}\"" for v in ("Bicycle", "Car", "Motorbike", "Scooter")) + " FROM q GROUP BY 1",
    "og1_partner_average": f"SELECT partner_id, {rdiv('sum(mins)', 'count(mins)', 6)} AS avg_time FROM prt LEFT JOIN dl USING (partner_id) GROUP BY partner_id",
}
