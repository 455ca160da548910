"""Retention, segments, value, churn, acquisition."""

from oracle.prelude import cavg, money, pct, rdiv
from oracle.views import AS_OF, RFM


def act(only: str = "WHERE dlv") -> str:
    return f""", firsts AS (SELECT cid, min(m) AS c0 FROM ord {only} GROUP BY cid),
sz AS (SELECT c0, count(*) AS n0 FROM firsts GROUP BY c0),
act AS (SELECT c0, (12*(year(m)-year(c0))+month(m)-month(c0))::INT AS k, count(DISTINCT cid) AS a
 FROM (SELECT cid, m FROM ord {only}) x JOIN firsts USING (cid) GROUP BY 1, 2)"""


VALUE = f""", cv AS (
 SELECT cid, count(*) AS n, sum(total_c) AS ltv_c, {rdiv('sum(total_c)', 'count(*)', 0)}::BIGINT AS aov_c,
  min(d) AS d0, max(d) AS d1, datediff('day', min(d), {AS_OF}) AS age,
  ({rdiv('count(*)*30', "datediff('day', min(d), " + AS_OF + ")", 2)}*100)::BIGINT AS opm_c
 FROM ord WHERE dlv GROUP BY cid)"""


def churn(fix: bool) -> str:
    t, n = ("1", "1") if fix else ("greatest(t,1)", "greatest(n,1)")
    return f""", oc AS (SELECT cid, max(d) AS dm, count(*) AS n, sum(total_c) AS sc, count_if(d>=DATE '2001-07-03') AS a,
 count_if(d BETWEEN DATE '2001-06-03' AND DATE '2001-07-02') AS b, count_if(can) AS x FROM ord GROUP BY cid),
tc AS (SELECT cid, count(*) AS t FROM tk WHERE created_at >= TIMESTAMP '2001-05-04' GROUP BY cid),
j AS (SELECT cid, customer_name, customer_tier, city_name, datediff('day', dm, {AS_OF})::INT AS idle, coalesce(n,0) AS n, sc,
 coalesce(a,0) AS a, coalesce(b,0) AS b, coalesce(x,0) AS x, coalesce(t,0) AS t
 FROM cust JOIN city USING (city_id) LEFT JOIN oc USING (cid) LEFT JOIN tc USING (cid) WHERE is_active),
k AS (SELECT *, (sc*{t})::BIGINT AS spent_c, (a*{t})::BIGINT AS la, (b*{t})::BIGINT AS lb FROM j)
SELECT cid AS customer_id, customer_name, customer_tier, city_name, idle AS days_since_last_order, n::BIGINT AS total_orders,
 {money('spent_c')} AS total_spent, la AS orders_last_30d, lb AS orders_prev_30d, (t*{n})::BIGINT AS support_tickets,
 {pct('x*' + t, 'n', 1)} AS cancellation_rate_pct,
 CASE WHEN 2*la<lb THEN 'Declining Fast' WHEN la<lb THEN 'Declining' ELSE 'Stable/Growing' END AS order_trend,
 CASE WHEN idle<=14 THEN 'Active' WHEN idle<=30 THEN 'Cooling' WHEN idle<=60 THEN 'At Risk' WHEN idle<=90 THEN 'Churning' ELSE 'Churned' END AS churn_segment,
 CASE WHEN idle>60 AND spent_c>500000 THEN '🚨 Win-Back VIP — send ₹100 voucher' WHEN idle>45 AND spent_c>200000 THEN '⚠️  Retention offer needed'
  WHEN la=0 AND n>10 THEN '📧 Re-engagement push notification' ELSE '— Standard flow' END AS recommended_action FROM k"""


def channels(fix: bool) -> str:
    w = "1" if fix else "n"
    return f""", per AS (SELECT cid, count(*) AS n, sum(total_c) AS l FROM ord WHERE dlv GROUP BY cid)
SELECT acquisition_channel, count(*) AS total_customers, count(n) AS ordering_customers, {pct('count(n)', 'count(*)', 1)} AS activation_rate_pct,
 coalesce(sum(n),0)::BIGINT AS total_orders, {rdiv('sum(n)', 'count(n)', 1)} AS avg_orders_per_active, {money('sum(l)')} AS total_revenue,
 {rdiv(f'sum(l*{w})', f'sum(CASE WHEN n IS NOT NULL THEN {w} END)*100', 2)} AS avg_ltv, {rdiv('sum(l)', 'count(*)*100', 2)} AS revenue_per_acquired_customer
FROM cust LEFT JOIN per USING (cid) GROUP BY acquisition_channel"""


def _matrix(ks: tuple[int, ...]) -> str:
    return ", ".join(f"{pct(f'coalesce(max(CASE WHEN k={k} THEN a END),0)', 'n0', 1)} AS m{k}" for k in ks)


SQL = {
    "cu1_cohort_retention": act() + f""" SELECT strftime(c0,'%Y-%m') AS cohort, n0 AS cohort_size, k AS month_number, a AS active_customers,
 {pct('a', 'n0', 1)} AS retention_pct, {pct('n0-a', 'n0', 1)} AS cumulative_churn_pct FROM act JOIN sz USING (c0) WHERE k<=12""",
    "cu2_rfm_summary": RFM + f""" SELECT rfm_segment, count(*) AS customer_count, {pct('count(*)', '(SELECT count(*) FROM rfm)', 2)} AS pct_of_customers,
 {cavg('mon_c')} AS avg_lifetime_spend, {money('sum(mon_c)')} AS total_revenue, {pct('sum(mon_c)', '(SELECT sum(mon_c) FROM rfm)', 2)} AS pct_of_revenue,
 {rdiv('sum(recency_days)', 'count(*)', 0)} AS avg_days_since_order, {rdiv('sum(frequency)', 'count(*)', 1)} AS avg_orders,
 {rdiv('sum(r_score)', 'count(*)', 2)} AS avg_r_score, {rdiv('sum(f_score)', 'count(*)', 2)} AS avg_f_score, {rdiv('sum(m_score)', 'count(*)', 2)} AS avg_m_score
 FROM rfm GROUP BY rfm_segment""",
    "cu3_lifetime_value": VALUE + f""" SELECT cid AS customer_id, customer_name, customer_tier, city_name, acquisition_channel, n AS total_orders,
 {money('ltv_c')} AS historical_ltv, {money('aov_c')} AS avg_order_value, d0 AS first_order_date, d1 AS last_order_date, age::INT AS customer_age_days,
 {money('opm_c')} AS orders_per_month, {rdiv('opm_c*12*aov_c', '10000', 2)} AS projected_12m_ltv, rank() OVER (ORDER BY ltv_c DESC) AS ltv_rank,
 ntile(10) OVER (ORDER BY ltv_c, cid)::INT AS ltv_decile, coalesce({pct('rank() OVER (ORDER BY ltv_c)-1', 'count(*) OVER ()-1', 1)},0) AS ltv_percentile
 FROM cv JOIN cust USING (cid) JOIN city USING (city_id)""",
    "cu4_churn_risk": churn(False),
    "cu4_churn_risk_corrected": churn(True),
    "cu5_acquisition_channels": channels(False),
    "cu5_acquisition_channels_corrected": channels(True),
    "cu6_recency_bands": f""", lo AS (SELECT cid, datediff('day', max(d), {AS_OF}) AS i FROM ord WHERE dlv GROUP BY cid)
SELECT CASE WHEN i<=7 THEN '0-7 days' WHEN i<=14 THEN '8-14 days' WHEN i<=30 THEN '15-30 days' WHEN i<=60 THEN '31-60 days'
 WHEN i<=90 THEN '61-90 days' WHEN i<=180 THEN '91-180 days' ELSE '180+ days (Churned)' END AS recency_band, count(*) AS customers,
 {pct('count(*)', '(SELECT count(*) FROM lo)', 2)} AS pct_of_customers FROM lo GROUP BY 1""",
    "i27_spending_quintiles": f""", sp AS (SELECT cid, sum(total_c) AS c FROM ord WHERE dlv GROUP BY cid), t AS (SELECT *, ntile(5) OVER (ORDER BY c, cid)::INT AS quintile FROM sp)
SELECT quintile, count(*) AS customers, {money('min(c)')} AS min_spend, {money('max(c)')} AS max_spend, {cavg('c')} AS avg_spend, {money('sum(c)')} AS total_revenue FROM t GROUP BY quintile""",
    "i31_cohort_matrix": act() + f" SELECT strftime(c0,'%Y-%m') AS cohort, n0 AS cohort_size, {_matrix((0, 1, 3, 6))} FROM act JOIN sz USING (c0) GROUP BY c0, n0",
    "i33_value_quintiles": VALUE + f""", t AS (SELECT *, ntile(5) OVER (ORDER BY ltv_c DESC, cid)::INT AS ltv_quintile FROM cv)
SELECT ltv_quintile, count(*) AS customers, {cavg('ltv_c')} AS avg_ltv, {money('sum(ltv_c)')} AS total_revenue, {rdiv('sum(n)', 'count(*)', 1)} AS avg_orders,
 {cavg('aov_c')} AS avg_aov, {cavg('opm_c')} AS avg_orders_per_month, {rdiv('sum(opm_c)*sum(aov_c)*12', 'count(opm_c)*count(*)*10000', 2)} AS projected_12m_ltv FROM t GROUP BY ltv_quintile""",
    "nb1_retention_rows": act() + f" SELECT strftime(c0,'%Y-%m') AS cohort, n0 AS sz, k AS month_num, {pct('a', 'n0', 1)} AS retention_pct FROM act JOIN sz USING (c0) WHERE k<=6",
    "nb1_retention_pivot": act() + " SELECT strftime(c0,'%Y-%m') AS cohort, " + ", ".join(
        f"max(CASE WHEN k={k} THEN {pct('a', 'n0', 1)} END) AS m{k}" for k in range(7)) + " FROM act JOIN sz USING (c0) GROUP BY c0",
    "nb1_mean_month_1": act() + f""", r AS (SELECT ({pct('a', 'n0', 1)}*10)::BIGINT AS x FROM act JOIN sz USING (c0) WHERE k=1)
SELECT {rdiv('sum(x)', 'count(*)*10', 1)} AS avg_month_1_retention_pct FROM r""",
    "rd2_cohort_activity_all": act("") + " SELECT strftime(c0,'%Y-%m') AS cohort, k AS month_number, a AS active_customers FROM act WHERE k<=6",
    "x1_retention_report": act() + f""", w AS (SELECT c0, n0, coalesce(max(CASE WHEN k=1 THEN a END),0) AS a1, coalesce(max(CASE WHEN k=3 THEN a END),0) AS a3,
 coalesce(max(CASE WHEN k=6 THEN a END),0) AS a6 FROM act JOIN sz USING (c0) WHERE c0=DATE '1996-01-01' GROUP BY c0, n0)
SELECT strftime(c0,'%Y-%m') AS cohort_month, n0 AS cohort_size, a1 AS retained_m1, a3 AS retained_m3, a6 AS retained_m6,
 {pct('a1', 'n0', 1)} AS retention_m1_pct, {pct('a3', 'n0', 1)} AS retention_m3_pct, {pct('a6', 'n0', 1)} AS retention_m6_pct FROM w""",
}
