"""The star read as a marketplace, in DuckDB SQL. Money is in whole cents (columns ending in _c)."""

from __future__ import annotations

CUISINES = ["North Indian", "South Indian", "Chinese", "Italian", "Mexican", "Fast Food", "Pizza", "Biryani",
            "Rolls & Wraps", "Desserts"]
PAYMENTS = ["UPI", "Credit Card", "Debit Card", "Cash", "Wallet", "NetBanking"]
REASONS = ["Changed mind", "Ordered by mistake", "Restaurant too busy", "Estimated time too long",
           "Found better option", "Payment failed", "No delivery partner available", "Restaurant closed"]
ISSUES = ["Wrong Item", "Missing Item", "Late Delivery", "Cancelled by Restaurant", "Payment Issue",
          "Refund Request", "Quality Issue", "Other"]


def _l(values: list) -> str:
    return "[" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values) + "]"


PROMOS = """(VALUES
 (1,'WELCOME50','New User Welcome','FLAT',5000,14900,5000,NULL,DATE '2021-01-01',DATE '2026-12-31',true,'NEW_USER'),
 (2,'SAVE20','Save 20%','PERCENT',2000,19900,8000,100000,DATE '2021-01-01',DATE '2026-12-31',true,'ALL'),
 (3,'FREEDEL','Free Delivery','FREE_DELIVERY',4000,9900,4000,NULL,DATE '2021-01-01',DATE '2026-12-31',true,'ALL'),
 (4,'WEEKEND30','Weekend Special 30%','PERCENT',3000,24900,12000,50000,DATE '2021-01-01',DATE '2026-12-31',true,'ALL'),
 (5,'LOYAL100','Loyalty Reward ₹100','FLAT',10000,39900,10000,NULL,DATE '2022-01-01',DATE '2026-12-31',true,'EXISTING'),
 (6,'FLASH40','Flash Sale 40%','PERCENT',4000,29900,15000,10000,DATE '2023-01-01',DATE '2023-12-31',false,'ALL'),
 (7,'DINNER25','Dinner Rush 25%','PERCENT',2500,19900,10000,75000,DATE '2022-01-01',DATE '2026-12-31',true,'ALL'),
 (8,'NEWREST50','New Restaurant ₹50','FLAT',5000,14900,5000,NULL,DATE '2023-01-01',DATE '2026-12-31',true,'ALL'),
 (9,'MONSOON20','Monsoon Special','PERCENT',2000,19900,8000,30000,DATE '2023-06-01',DATE '2023-09-30',false,'ALL'),
 (10,'FESTIVE100','Festival Bonus','FLAT',10000,49900,10000,25000,DATE '2023-10-01',DATE '2023-11-30',false,'ALL')
) v(promotion_id,promo_code,promo_name,promo_type,value_c,least_c,cap_c,max_uses,start_date,end_date,listed,applicable_to)"""

PRELUDE = f"""WITH city AS (
 SELECT n_nationkey::BIGINT AS city_id, n_name AS city_name, r_name AS state
 FROM nation JOIN region ON n_regionkey = r_regionkey),
zn AS (
 SELECT n_nationkey::BIGINT*10+z AS zone_id, n_nationkey::BIGINT AS city_id,
        n_name || ' Zone ' || z AS zone_name, (20+2*z)::INT AS target
 FROM nation, (VALUES (1),(2)) k(z)),
fl AS (
 SELECT l_orderkey AS fk, min(struct_pack(a := l_linenumber, b := l_partkey, c := l_suppkey, d := l_quantity,
        e := l_discount, f := l_tax)) AS s FROM lineitem GROUP BY l_orderkey),
o1 AS (
 SELECT o_orderkey AS oid, o_custkey AS cid, c_nationkey::BIGINT*10+1+o_orderkey%2 AS zid,
        o_orderdate::TIMESTAMP + to_seconds(o_orderkey*7919%86400) AS ts, o_orderdate::DATE AS d,
        CASE WHEN o_orderstatus<>'P' THEN 'Delivered' WHEN o_orderkey%3<>0 THEN 'Cancelled' ELSE 'On The Way' END AS st,
        round(o_totalprice*100)::BIGINT AS sub_c, s IS NOT NULL AS lined,
        coalesce(s.c, o_orderkey%10) AS rid, s.d::INT AS qty, coalesce(round(s.e*100)::BIGINT,0) AS dp,
        round(s.f*100)::BIGINT AS km,
        [0,2900,3900,4900][(o_orderkey%4+1)::INT]::BIGINT AS fee_c
 FROM orders JOIN customer ON o_custkey=c_custkey LEFT JOIN fl ON fk=o_orderkey),
o2 AS (SELECT *, (sub_c*dp+50)//100 AS disc_c FROM o1),
o3 AS (SELECT *, ((sub_c-disc_c)*5+50)//100 AS tax_c FROM o2),
o4 AS (SELECT *, sub_c-disc_c+fee_c+tax_c AS total_c FROM o3),
ord AS (
 SELECT *, (total_c*[15,18,20,22,25,30][(rid%6+1)::INT]+50)//100 AS comm_c,
        st='Delivered' AS dlv, st='Cancelled' AS can, date_trunc('month', d)::DATE AS m,
        {_l(['App', 'Web', 'Phone'])}[(oid//3%3+1)::INT] AS channel,
        {_l(PAYMENTS)}[(oid//4%6+1)::INT] AS pay,
        CASE WHEN oid%5=0 THEN oid//5%10+1 END AS pid,
        CASE WHEN st='Cancelled' AND oid%400<>1 THEN {_l(REASONS)}[(oid//3%8+1)::INT] END AS reason,
        CASE WHEN st<>'Cancelled' AND oid%50>0 THEN ts + INTERVAL 2 MINUTE END AS confirmed_at,
        CASE WHEN st<>'Cancelled' AND oid%50>1 THEN ts + INTERVAL 8 MINUTE END AS prepared_at,
        CASE WHEN st<>'Cancelled' AND oid%50>2 THEN ts + INTERVAL 9 MINUTE END AS picked_up_at,
        CASE WHEN st='Delivered' THEN ts + to_minutes(coalesce(qty+10, 40)) END AS delivered_at,
        CASE WHEN st='Cancelled' THEN ts + to_minutes((oid%20+2)::INT) END AS cancelled_at,
        st='Cancelled' AND oid%2=0 AS refunded,
        CASE WHEN st='Cancelled' AND oid%2=0 THEN total_c ELSE 0 END AS refund_c
 FROM o4),
cust_tot AS (SELECT cid, count(*) AS n, sum(total_c) AS spent_c, max(delivered_at) AS last_at FROM ord WHERE dlv GROUP BY cid),
cust AS (
 SELECT c_custkey AS cid, c_name AS customer_name, 'user'||c_custkey||'@example.com' AS email, c_nationkey::BIGINT AS city_id,
        TIMESTAMP '1995-01-01' + to_days((c_custkey*7%2000)::INT) AS registration_date,
        c_custkey%25<>0 AS is_active, c_mktsegment AS acquisition_channel,
        coalesce(n,0) AS total_orders, coalesce(spent_c,0) AS spent_c, last_at,
        CASE WHEN coalesce(spent_c,0)>=1000000 THEN 'Platinum' WHEN spent_c>=500000 THEN 'Gold'
             WHEN spent_c>=200000 THEN 'Silver' ELSE 'Bronze' END AS customer_tier
 FROM customer LEFT JOIN cust_tot ON cid=c_custkey),
rest_tot AS (SELECT rid, count(*) AS n, sum(total_c) AS rev_c FROM ord WHERE dlv GROUP BY rid),
rest AS (
 SELECT s_suppkey AS rid, s_name AS restaurant_name, {_l(CUISINES)}[(s_suppkey%10+1)::INT] AS cuisine_type,
        s_nationkey::BIGINT AS city_id, s_nationkey::BIGINT*10+1+s_suppkey%2 AS zone_id,
        250+s_suppkey*37%251 AS rating_c, [15,18,20,22,25,30][(s_suppkey%6+1)::INT] AS rate,
        s_suppkey%20<>0 AS is_active, DATE '1995-01-01' + (s_suppkey*13%365)::INT AS joining_date,
        coalesce(n,0) AS total_orders, coalesce(rev_c,0) AS total_rev_c
 FROM supplier LEFT JOIN rest_tot ON rid=s_suppkey),
dl AS (
 SELECT oid, zid*10+oid//2%4 AS partner_id, ts + to_minutes((2+oid%5)::INT) AS assigned_at,
        ts + to_minutes(qty+10) AS delivered_at, qty+10 AS mins, (25+zid%10*2)::INT AS expected,
        km*100 AS km_c, fee_c, fee_c*7//10 + km*200 AS earn_c,
        CASE WHEN dlv THEN 'Delivered' ELSE 'Failed' END AS ds, dlv AS done,
        qty+10>45 AS breached, qty+10<=25+zid%10*2 AS on_time,
        CASE WHEN oid%4<>0 THEN oid*11%5+1 END AS delivery_rating
 FROM ord WHERE NOT can AND lined AND oid%20<>0),
part_tot AS (SELECT partner_id, count_if(done) AS n, coalesce(sum(CASE WHEN done THEN earn_c END),0) AS earn_c FROM dl GROUP BY partner_id),
prt AS (
 SELECT zone_id*10+k AS partner_id, 'Partner '||(zone_id*10+k) AS partner_name, city_id, zone_id,
        ['Motorbike','Bicycle','Scooter','Car'][k+1] AS vehicle_type, (zone_id*10+k)%12<>0 AS is_active,
        ['Available','Offline','On Delivery'][((zone_id*10+k)%3+1)::INT] AS current_status,
        300+(zone_id*10+k)*17%201 AS rating_c, DATE '1995-01-01' + ((zone_id*10+k)*11%700)::INT AS joining_date,
        (zone_id*10+k)%5<>0 AS bg_verification, coalesce(n,0) AS total_deliveries, coalesce(earn_c,0) AS earn_c
 FROM zn CROSS JOIN (VALUES (0),(1),(2),(3)) q(k) LEFT JOIN part_tot ON part_tot.partner_id=zone_id*10+k),
item AS (
 SELECT s*10000000000+p AS item_id, s AS rid, p_name AS item_name, round(p_retailprice*100)::BIGINT AS price_c,
        p%11<>0 AS is_available, p%2=0 AS is_vegetarian, p%7=0 AS is_bestseller, s*10+1+p%2 AS category_id, (p%600+100)::INT AS calories
 FROM (SELECT DISTINCT l_suppkey AS s, l_partkey AS p FROM lineitem) JOIN part ON p=p_partkey),
oi AS (
 SELECT l_orderkey AS oid, l_suppkey*10000000000+l_partkey AS item_id, l_suppkey AS rid, l_quantity::INT AS quantity,
        round(p_retailprice*100)::BIGINT AS price_c, l_quantity::INT*round(p_retailprice*100)::BIGINT AS item_c,
        l_orderkey*10+l_linenumber AS order_item_id
 FROM lineitem JOIN part ON l_partkey=p_partkey),
rv AS (
 SELECT oid, cid, rid, greatest(1,least(5,[3,4,5,2][(rid%4+1)::INT]+oid%3-1))::INT AS food,
        CASE WHEN oid%9<>0 THEN oid*11%5+1 END AS dr, CASE WHEN oid%10<>0 THEN oid*13%5+1 END AS ov,
        ts + INTERVAL 1 DAY AS created_at,
        CASE WHEN lined AND oid%20<>0 THEN zid*10+oid//2%4 END AS partner_id
 FROM ord WHERE dlv AND oid%4<>0 AND rid%10<>9),
tk0 AS (
 SELECT oid//12 AS ticket_id, oid, cid, {_l(ISSUES)}[(oid//12%8+1)::INT] AS issue_type,
        ['Open','In Progress','Resolved','Closed','Escalated'][(oid//12%5+1)::INT] AS status,
        ['Low','Medium','High','Critical'][(oid//12//8%4+1)::INT] AS priority,
        ts + INTERVAL 2 HOUR AS created_at, oid//12%48+1 AS hrs FROM ord WHERE oid%12=0),
tk AS (
 SELECT *, CASE WHEN status IN ('Resolved','Closed') THEN created_at + to_hours(hrs) END AS resolved_at,
        status IN ('Resolved','Closed') AND coalesce(hrs > CASE priority WHEN 'Critical' THEN 2 WHEN 'High' THEN 8 WHEN 'Medium' THEN 24 END, false) AS breached
 FROM tk0),
pay AS (
 SELECT oid, total_c AS amount_c, pay AS payment_method, CASE WHEN can THEN 'Refunded' ELSE 'Completed' END AS payment_status,
        ts AS payment_timestamp, CASE WHEN can THEN total_c ELSE 0 END AS refund_c, 'TXN'||lpad(oid::VARCHAR,10,'0') AS transaction_id
 FROM ord),
uses AS (SELECT pid, count(*) AS n FROM ord WHERE pid IS NOT NULL GROUP BY pid),
promo AS (
 SELECT v.*, coalesce(n,0) AS current_uses, listed AND (max_uses IS NULL OR coalesce(n,0)<max_uses) AS is_active
 FROM {PROMOS} LEFT JOIN uses ON pid=promotion_id),
hist AS (
 SELECT oid, i, status, changed_at FROM (
  SELECT oid, unnest([1,2,3,4,5,6,7,8]) AS i,
   unnest(['Placed','Confirmed','Preparing','Ready','Picked Up','On The Way','Delivered','Cancelled']) AS status,
   unnest([ts, confirmed_at, confirmed_at + INTERVAL 1 MINUTE, prepared_at, picked_up_at, picked_up_at + INTERVAL 1 MINUTE,
           delivered_at, cancelled_at]) AS changed_at FROM ord) WHERE changed_at IS NOT NULL)"""


def rdiv(num: str, den: str, places: int, times: int = 1) -> str:
    """num*times/den rounded half away from zero at ``places``, as DOUBLE; NULL when den is 0."""
    n, d = f"(({num})::HUGEINT*{times * 10 ** places})", f"nullif(({den})::HUGEINT,0)"
    return (f"(CASE WHEN ({n}<0)<>({d}<0) THEN -1 ELSE 1 END * ((2*abs({n})+abs({d}))//(2*abs({d}))))::DOUBLE"
            f"/{10 ** places}")


def pct(num: str, den: str, places: int) -> str:
    return rdiv(num, den, places, 100)


def cavg(cents: str, places: int = 2) -> str:
    """Average of a cents column, in currency."""
    return rdiv(f"sum({cents})", f"count({cents})*100", places)


def money(cents: str) -> str:
    return f"({cents})::DOUBLE/100"


def ptile(value: str, point: int, places: int, unit: int = 1) -> str:
    """Exact continuous percentile of an integer value (divided by ``unit``) over the group."""
    v = f"list(({value})::BIGINT ORDER BY {value}) FILTER (WHERE ({value}) IS NOT NULL)"
    n = f"count({value})"
    pos = f"(({n}-1)*{point})"
    low, high = f"({v})[{pos}//100+1]", f"({v})[least({pos}//100+2, {n})]"
    return rdiv(f"{low}*(100-{pos}%100)+{high}*({pos}%100)", str(100 * unit), places)


def sql(body: str) -> str:
    """Prelude plus a body that starts with SELECT or with ``, name AS (...)``."""
    return PRELUDE + ("\n" if not body.lstrip().startswith(",") else "") + body
