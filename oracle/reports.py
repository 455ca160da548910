"""Short reports over the summary views."""

from oracle.prelude import cavg, money, rdiv
from oracle.views import DEMAND, PARTPERF, RESTPERF, RFM

# Names and bounds of the bands.
BANDS = "CASE WHEN recency_days<=14 THEN 'Active (0-14d)' WHEN recency_days<=30 THEN 'Cooling (15-30d)' WHEN recency_days<=60 THEN 'At Risk (31-60d)' WHEN recency_days<=90 THEN 'Churning (61-90d)' ELSE 'Churned (90d+)' END"

SQL = {
    "ru2_peak_cells": DEMAND + " SELECT day_of_week, day_name, hour_of_day, order_count, demand_index, avg_order_value FROM demand ORDER BY demand_index DESC, day_of_week, hour_of_day LIMIT 50",
    "ru3_top_restaurants": RESTPERF + " SELECT restaurant_name, cuisine_type, city_name, total_orders, gross_revenue, avg_order_value, avg_food_rating, revenue_rank FROM restperf WHERE revenue_rank<=20",
    "ru4_rfm_segments": RFM + f" SELECT rfm_segment, count(*) AS customers, {cavg('mon_c')} AS avg_ltv, {money('sum(mon_c)')} AS total_revenue FROM rfm GROUP BY 1",
    "ru5_delivery_profiles": PARTPERF + " SELECT DISTINCT zone_name, city_name, total_deliveries, avg_delivery_time, on_time_rate_pct, sla_breaches FROM partperf ORDER BY total_deliveries DESC, zone_name, city_name, avg_delivery_time, on_time_rate_pct, sla_breaches LIMIT 30",
    "ru6_churn_segments": RFM + f" SELECT rfm_segment AS churn_segment, count(*) AS customers, {rdiv('sum(recency_days)', 'count(*)', 0)} AS avg_days_inactive, {cavg('mon_c')} AS avg_ltv FROM rfm WHERE rfm_segment IN ('At Risk','Hibernating','Lost') GROUP BY 1",
    "nb2_rfm_distribution": RFM + f" SELECT rfm_segment, count(*) AS customers, {cavg('mon_c', 0)} AS avg_ltv, {rdiv('sum(mon_c)', '100', 0)} AS total_revenue, {rdiv('sum(recency_days)', 'count(*)', 0)} AS avg_days_inactive FROM rfm GROUP BY 1",
    "nb3_recency_revenue": RFM + f" SELECT {BANDS} AS segment, count(*) AS customers, {rdiv('sum(mon_c)', '100', 0)} AS at_risk_revenue FROM rfm GROUP BY 1",
    "nb7_demand_heatmap": DEMAND + " SELECT day_of_week, day_name, hour_of_day, order_count, demand_index FROM demand",
    "nb7_demand_pivot": DEMAND + " SELECT day_of_week, " + ", ".join(f"max(demand_index) FILTER (WHERE hour_of_day={h}) AS h{h}" for h in range(24)) + " FROM demand GROUP BY 1",
    "nb10_valuable_at_risk": RFM + f" SELECT count_if(recency_days>60 AND mon_c>200000)::BIGINT AS high_val_at_risk, {rdiv('sum(mon_c) FILTER (WHERE recency_days>60 AND mon_c>200000)', '100', 0)} AS revenue_at_risk FROM rfm",
}
