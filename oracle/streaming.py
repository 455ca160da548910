"""Running totals, audit log, live monitor and demand windows."""

from oracle.prelude import money, rdiv

CUST = f"SELECT cid AS customer_id, n AS total_orders, {money('spent_c')} AS total_spent, last_at AS last_order_date, customer_tier FROM cust_tot JOIN (SELECT cid, customer_tier FROM cust) USING (cid)"
REST = f"SELECT rid AS restaurant_id, n AS total_orders, {money('rev_c')} AS total_revenue FROM rest_tot"
PART = f"SELECT partner_id, count(*) AS total_deliveries, {money('sum(earn_c)')} AS total_earnings FROM dl WHERE done GROUP BY 1"
PROMO = "SELECT promotion_id, promo_code, current_uses, max_uses IS NULL OR current_uses<max_uses AS is_active FROM promo"
RATE = f"SELECT rid AS restaurant_id, {rdiv('sum(ov)', 'count(ov)', 2)} AS rating, count(*) AS total_ratings FROM rv GROUP BY 1"
PRATE = f"SELECT partner_id, {rdiv('sum(delivery_rating)', 'count(delivery_rating)', 2)} AS rating FROM dl GROUP BY 1"
EV = """, se AS (SELECT event_id, user_id AS order_id, ts AS changed_at, round(value*100)::BIGINT AS cents,
 CASE event_type WHEN 'signup' THEN 'Placed' WHEN 'view' THEN 'Confirmed' WHEN 'click' THEN 'Preparing' WHEN 'purchase' THEN 'Delivered' ELSE 'Cancelled' END AS status FROM events),
lg AS (SELECT *, lag(status) OVER (PARTITION BY order_id ORDER BY changed_at, event_id) AS from_status FROM se)"""
LOG = EV + " SELECT order_id, from_status, status, changed_at FROM lg WHERE status IS DISTINCT FROM from_status"
FIRST = EV + " SELECT order_id, status, changed_at FROM lg WHERE from_status IS NULL"
LIVE = EV + """, lt AS (SELECT order_id, arg_max(status, (changed_at, event_id)) AS status FROM se GROUP BY 1)
SELECT status, count(*) AS orders, status NOT IN ('Delivered','Cancelled') AS is_open FROM lt GROUP BY 1"""
CLOSED = ", window_end <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM events) AS is_closed"


def windows(hours: int, more: str = "") -> str:
    return EV + f""", sp AS (SELECT date_trunc('hour', changed_at) - to_hours(unnest(range({hours}))) AS window_start, cents FROM se),
gr AS (SELECT window_start, window_start + INTERVAL {hours} HOUR AS window_end, count(*) AS events, sum(cents)::BIGINT AS cents FROM sp GROUP BY 1) SELECT *{more} FROM gr"""


SQL = {
    "t1_restaurant_ratings": RATE, "t1_restaurant_ratings_stream": RATE,
    "t2_partner_ratings": PRATE, "t2_partner_ratings_stream": PRATE,
    "t3_audit_log": LOG, "t3_audit_log_stream": LOG,
    "t3_first_status": FIRST, "t3_first_status_stream": FIRST,
    "t4_customer_totals": CUST, "t4_customer_totals_stream": CUST,
    "t5_restaurant_totals": REST, "t5_restaurant_totals_stream": REST,
    "t6_promotion_usage": PROMO, "t6_promotion_usage_stream": PROMO,
    "t7_partner_totals": PART, "t7_partner_totals_stream": PART,
    "t8_live_monitor": LIVE, "t8_live_monitor_stream": LIVE,
    "t8_unassigned_orders": "SELECT zid AS zone_id, count(*) AS unassigned, min(ts) AS waiting_since FROM ord WHERE st='On The Way' AND oid NOT IN (SELECT oid FROM dl) GROUP BY 1",
    "t9_hourly_demand": windows(1), "t9_hourly_demand_stream": windows(1, CLOSED),
    "t9_smoothed_demand": windows(3), "t9_smoothed_demand_stream": windows(3, CLOSED),
}
