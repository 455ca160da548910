"""Request batches."""

from oracle.prelude import money, rdiv

CODES = "['WELCOME50','SAVE20','FREEDEL','WEEKEND30','LOYAL100','FLASH40','DINNER25','NEWREST50','MONSOON20','FESTIVE100','NOSUCHCODE']"
CART = f""", ca AS (SELECT oid, sum(quantity*price_c) AS sub, count_if(NOT coalesce(is_available,false)) AS bad, arg_min(item_id, (item_id, quantity)) FILTER (WHERE NOT coalesce(is_available,false)) AS bad_item
 FROM oi LEFT JOIN (SELECT item_id, is_available FROM item) USING (item_id) GROUP BY oid),
q AS (SELECT o.oid, o.cid, o.rid, o.ts, o.pay, o.channel, {CODES}[(o.oid%13+1)::INT] AS code, coalesce(sub,0) AS sub, bad_item, c.is_active AS c_ok, r.is_active AS r_ok, r.zone_id, r.rate
 FROM ord o JOIN (SELECT cid, is_active FROM cust) c USING (cid) JOIN rest r ON r.rid=o.rid LEFT JOIN ca ON ca.oid=o.oid),
e AS (SELECT *, CASE WHEN oid%211 IN (7,8) THEN '22P02' WHEN NOT c_ok THEN 'P0001' WHEN NOT r_ok THEN 'P0002' WHEN bad_item IS NOT NULL THEN 'P0003' END AS err FROM q),
lv AS (SELECT *, max_uses-current_uses AS left_ FROM promo WHERE is_active AND DATE '2023-06-15' BETWEEN start_date AND end_date AND (max_uses IS NULL OR current_uses<max_uses)),
f0 AS (SELECT e.*, promotion_id, promo_type, value_c, cap_c, left_ FROM e LEFT JOIN lv ON promo_code=code AND sub>=least_c WHERE err IS NULL),
f1 AS (SELECT *, CASE WHEN promotion_id IS NOT NULL AND (left_ IS NULL OR row_number() OVER (PARTITION BY promotion_id ORDER BY ts, oid)<=left_) THEN promotion_id END AS p FROM f0),
f2 AS (SELECT *, CASE WHEN p IS NULL THEN 0 WHEN promo_type='FLAT' THEN least(value_c, sub) WHEN promo_type='PERCENT' THEN least((sub*value_c+5000)//10000, coalesce(cap_c,99999900)) ELSE 0 END AS disc,
 CASE WHEN p IS NOT NULL AND promo_type='FREE_DELIVERY' THEN 0 ELSE 3900 END AS fee FROM f1),
f3 AS (SELECT *, ((sub-disc)*5+50)//100 AS tax FROM f2), f4 AS (SELECT *, sub-disc+fee+tax AS tot FROM f3)"""
EV = ", ev AS (SELECT event_id AS id, event_id//2*4 AS oid, event_type AS et, ts AS at_, round(value*100)::BIGINT AS vc FROM events)"
CANCEL = EV + """, cq AS (SELECT id, oid, et, at_, st, total_c, row_number() OVER (PARTITION BY oid ORDER BY at_, id) AS k FROM ev LEFT JOIN (SELECT oid, st, total_c FROM ord) USING (oid)),
cr AS (SELECT *, CASE WHEN st IS NULL THEN 'Order '||oid||' not found' WHEN st IN ('Delivered','Cancelled') THEN 'Cannot cancel order in status: '||st WHEN k>1 THEN 'Cannot cancel order in status: Cancelled' END AS msg FROM cq)"""
REFUND = EV + """, rq AS (SELECT id, oid, at_, CASE WHEN payment_status='Completed' THEN amount_c END AS paid, CASE WHEN et<>'view' THEN vc*1000 END AS asked FROM ev LEFT JOIN pay USING (oid)),
r1 AS (SELECT *, coalesce(asked, paid) AS ref, min(CASE WHEN coalesce(asked, paid)<=paid THEN (at_, id) END) OVER (PARTITION BY oid) AS win FROM rq),
rr_ AS (SELECT *, CASE WHEN paid IS NULL OR (at_, id)>win THEN 'No completed payment for order '||oid WHEN ref>paid THEN 'Refund amount ('||printf('%d.%02d', ref//100, ref%100)||') exceeds paid amount ('||printf('%d.%02d', paid//100, paid%100)||')' END AS msg FROM r1)"""
DONE = EV + """, kq AS (SELECT *, CASE WHEN et<>'view' THEN (vc+50)//100 END AS km FROM ev),
lq AS (SELECT *, arg_max(km, (at_, id)) FILTER (km IS NOT NULL) OVER (PARTITION BY oid) AS given FROM kq QUALIFY row_number() OVER (PARTITION BY oid ORDER BY at_ DESC, id DESC)=1)"""
ASSIGN = """, wt AS (SELECT oid, ts, zid, zid//10 AS city_id, row_number() OVER (PARTITION BY zid//10 ORDER BY ts, oid) AS k FROM ord WHERE st='On The Way' AND oid NOT IN (SELECT oid FROM dl)),
fp AS (SELECT * FROM prt WHERE is_active AND current_status='Available'),
wish AS (SELECT w.city_id, k, oid, partner_id, zone_id=zid AND bg_verification AS near,
 CASE WHEN zone_id=zid AND bg_verification THEN {'a': 0, 'b': -total_deliveries, 'c': -rating_c, 'd': partner_id} ELSE {'a': 1, 'b': 0, 'c': 0, 'd': partner_id} END AS pref FROM wt w JOIN fp p ON p.city_id=w.city_id),
turns AS (WITH RECURSIVE r(city_id, k, oid, pick, taken) AS (
 SELECT DISTINCT city_id, 0::BIGINT, NULL::BIGINT, {'p': NULL::BIGINT, 'near': NULL::BOOLEAN}, []::BIGINT[] FROM wt
 UNION ALL
 SELECT city_id, k, oid, pick, list_append(taken, pick.p) FROM (
  SELECT r.city_id, w.k, w.oid, r.taken, arg_min({'p': w.partner_id, 'near': w.near}, w.pref) AS pick
  FROM r JOIN wish w ON w.city_id=r.city_id AND w.k=r.k+1 AND NOT list_contains(r.taken, w.partner_id) GROUP BY ALL))
 SELECT * FROM r),
aa AS (SELECT oid, pick.p AS partner_id, CASE WHEN pick.near THEN 'zone' ELSE 'city' END AS matched_by FROM turns WHERE k>0)"""

SQL = {
    "x3_placed_orders": CART + f""" SELECT oid AS order_id, cid AS customer_id, rid AS restaurant_id, cid AS address_id, zone_id, p AS promotion_id, ts AS order_timestamp, 'Placed' AS order_status, channel AS order_channel, {money('sub')} AS subtotal_amount,
 {money('disc')} AS discount_amount, {money('fee')} AS delivery_fee, {money('tax')} AS taxes, {money('tot')} AS total_amount, {money('(tot*rate+50)//100')} AS platform_commission, pay AS payment_method FROM f4""",
    "x3_placed_items": CART + f" SELECT oid AS order_id, item_id, quantity, {money('price_c')} AS unit_price, {money('item_c')} AS item_total FROM oi WHERE oid IN (SELECT oid FROM f4)",
    "x3_placed_payments": CART + f" SELECT oid AS order_id, {money('tot')} AS amount, pay AS payment_method, 'Completed' AS payment_status, 'TXN'||lpad(oid::VARCHAR,10,'0') AS transaction_id, ts AS payment_timestamp FROM f4",
    "x3_rejects": CART + """ SELECT oid AS request_id, err AS error_code, CASE err WHEN '22P02' THEN 'Items are no list of item_id and quantity' WHEN 'P0001' THEN 'Customer '||cid||' not found or inactive' WHEN 'P0002' THEN 'Restaurant '||rid||' not found or inactive' ELSE 'Item '||bad_item||' not available' END AS message FROM e WHERE err IS NOT NULL""",
    "x4_cancelled_orders": CANCEL + " SELECT oid AS order_id, 'Cancelled' AS order_status, at_ AS cancelled_at, et AS cancellation_reason FROM cr WHERE msg IS NULL",
    "x4_refunds": CANCEL + f" SELECT oid AS payment_id, oid AS order_id, 'Refunded' AS payment_status, {money('total_c')} AS refund_amount, at_ AS refund_timestamp FROM cr JOIN pay USING (oid) WHERE msg IS NULL AND pay.payment_status='Completed'",
    "x4_rejects": CANCEL + " SELECT id AS request_id, oid AS order_id, msg AS message FROM cr WHERE msg IS NOT NULL",
    "x5_refunds": REFUND + f" SELECT oid AS order_id, CASE WHEN ref=paid THEN 'Refunded' ELSE 'Partially Refunded' END AS payment_status, {money('ref')} AS refund_amount, at_ AS refund_timestamp FROM rr_ WHERE msg IS NULL",
    "x5_rejects": REFUND + " SELECT id AS request_id, oid AS order_id, msg AS message FROM rr_ WHERE msg IS NOT NULL",
    "x6_restaurant_ratings": f"SELECT rid AS restaurant_id, coalesce({rdiv('sum(ov)', 'count(ov)', 2)},0) AS rating, count(ov) AS total_ratings FROM rest LEFT JOIN rv USING (rid) GROUP BY rid",
    "x7_assigned": ASSIGN + " SELECT oid AS order_id, partner_id, partner_name, matched_by, ts AS assigned_at, target AS expected_time_mins, ts+to_minutes(target) AS expected_delivery_time, 'Assigned' AS delivery_status FROM aa JOIN wt USING (oid) JOIN prt USING (partner_id) JOIN zn ON zn.zone_id=zid",
    "x7_orders": ASSIGN + " SELECT oid AS order_id, 'Confirmed' AS order_status, ts AS confirmed_at FROM aa JOIN wt USING (oid)",
    "x7_partners": ASSIGN + " SELECT partner_id, 'On Delivery' AS current_status FROM aa",
    "x7_rejects": ASSIGN + " SELECT oid AS order_id, 'P0010' AS error_code, 'No available delivery partners for order '||oid AS message FROM wt WHERE oid NOT IN (SELECT oid FROM aa)",
    "x8_completed": DONE + f" SELECT oid AS delivery_id, oid AS order_id, partner_id, 'Delivered' AS delivery_status, at_ AS delivered_at, (id%50+10)::INT AS actual_time_mins, {money('coalesce(given, km_c)')} AS distance_km, {money('fee_c*7//10+coalesce(km,300)*2')} AS partner_earnings FROM lq JOIN dl USING (oid)",
    "x8_orders": DONE + " SELECT oid AS order_id, 'Delivered' AS order_status, at_ AS delivered_at FROM lq JOIN dl USING (oid)",
    "x8_partners": DONE + " SELECT DISTINCT partner_id, 'Available' AS current_status FROM lq JOIN dl USING (oid) WHERE partner_id IS NOT NULL",
    "x8_rejects": DONE + " SELECT id AS request_id, oid AS order_id, 'No delivery record for order '||oid AS message FROM lq WHERE oid NOT IN (SELECT oid FROM dl)",
}
