"""Every named query as ``f(market, as_of) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import partial

from pyspark.sql import DataFrame, functions as F, types as T

from plateflow.functions.dates import days_before
from plateflow.model import Marketplace
from plateflow.operators import customers, delivery, executive, kpis, operations, quality, questions, reports, requests, \
    restaurants, views
from plateflow.plans import storage_checks as stored
from plateflow.sources import star_requests as asked
from plateflow.streaming import star_feeds as feeds

Query = Callable[[Marketplace, date], DataFrame]


def _placed(m: Marketplace) -> requests.Placed:
    return requests.place_orders(m, asked.order_requests(m), asked.PRICED_ON)


QUERIES: dict[str, Query] = {
    "v1_order_detail": views.order_detail,
    "v2_daily_kpi": views.daily_kpi,
    "v3_restaurant_performance": views.restaurant_performance,
    "v4_hourly_demand": views.hourly_demand,
    "v5_partner_performance": views.partner_performance,
    "v6_customer_rfm": views.customer_rfm,
    # customers
    "cu1_cohort_retention": customers.cohort_retention,
    "cu2_rfm_summary": customers.rfm_summary,
    "cu3_lifetime_value": customers.lifetime_value,
    "cu4_churn_risk": customers.churn_risk,
    "cu4_churn_risk_corrected": partial(customers.churn_risk, corrected=True),
    "cu5_acquisition_channels": customers.acquisition_channels,
    "cu5_acquisition_channels_corrected": partial(customers.acquisition_channels, corrected=True),
    "cu6_recency_bands": customers.recency_bands,
    "i27_spending_quintiles": customers.spending_quintiles,
    "i31_cohort_matrix": customers.cohort_matrix,
    "i33_value_quintiles": customers.value_quintiles,
    "nb1_retention_rows": customers.retention_rows,
    "nb1_retention_pivot": customers.retention_pivot,
    "nb1_mean_month_1": customers.mean_first_month_retention,
    "rd2_cohort_activity_all": customers.cohort_activity_all,
    "x1_retention_report": customers.retention_report,
    # delivery
    "de1_delivery_times": delivery.delivery_times,
    "de2_delivery_heatmap": delivery.delivery_heatmap,
    "de3_partner_scores": delivery.partner_scores,
    "de3_partner_scores_corrected": partial(delivery.partner_scores, corrected=True),
    "de4_zone_risk": delivery.zone_risk,
    "de4_zone_risk_corrected": partial(delivery.zone_risk, corrected=True),
    "de5_cancellation_reasons": delivery.cancellation_reasons,
    "de6_partner_earnings": delivery.partner_earnings,
    "x2_zone_performance": delivery.zone_performance,
    "i8_late_orders": delivery.late_orders,
    "i32_slow_partners": delivery.slow_partners,
    "i32_slow_partners_105": partial(delivery.slow_partners, ratio_percent=105),
    "i41_inactive_partners": delivery.inactive_partners,
    "i44_slow_zones": delivery.slow_zones,
    "i45_unassigned_risk": delivery.unassigned_risk,
    "nb11_late_share": delivery.late_share,
    "nb12_time_percentiles": delivery.time_percentiles,
    "nb12_time_histogram": delivery.time_histogram,
    "nb13_zone_late_share": delivery.zone_late_share,
    "nb14_quartile_by_vehicle": delivery.quartile_by_vehicle,
    "nb14_quartile_pivot": delivery.quartile_pivot,
    "og1_partner_average": delivery.partner_average,
    # restaurants
    "re1_monthly_ranking": restaurants.monthly_ranking,
    "re2_cuisine_share": restaurants.cuisine_share,
    "re3_health_scores": restaurants.health_scores,
    "re3_health_scores_corrected": partial(restaurants.health_scores, corrected=True),
    "re4_top_items": restaurants.top_items,
    "re5_onboarding_ramp": restaurants.onboarding_ramp,
    "i2_rated_active": restaurants.rated_active,
    "i5_popular_items": restaurants.popular_items,
    "i7_cancellation_by_cuisine": restaurants.cancellation_by_cuisine,
    "i10_recent_busy": restaurants.recent_busy,
    "i10_recent_busy_84": partial(restaurants.recent_busy, months=84),
    "i11_ratings_by_cuisine": restaurants.ratings_by_cuisine,
    "i15_unreviewed": restaurants.unreviewed,
    "i16_city_ranking": restaurants.city_ranking,
    "i17_second_cuisine": restaurants.nth_cuisine,
    "i22_peak_hours": restaurants.peak_hours,
    "i26_improved_ratings": restaurants.improved_ratings,
    "i26_improved_ratings_july": lambda m, as_of: restaurants.improved_ratings(m, days_before(as_of, 2)),
    "i28_longest_streaks": restaurants.longest_streaks,
    "i29_weekday_weekend": restaurants.weekday_weekend,
    "i34_declining": restaurants.declining,
    "i34_declining_july": lambda m, as_of: restaurants.declining(m, days_before(as_of, 2)),
    "i39_abc_items": restaurants.abc_classes,
    "i39_abc_items_all": partial(restaurants.abc_classes, k=None),
    "i42_ordered_together": restaurants.ordered_together,
    "nb8_top_cuisines": restaurants.top_cuisines,
    # operations
    "operations_1_demand_plan": operations.demand_plan,
    "operations_1_demand_plan_late_night": partial(operations.demand_plan, late_night=True),
    "operations_2_ticket_service": operations.ticket_service,
    "operations_3_promotion_effect": operations.promotion_effect,
    "operations_4_order_funnel": operations.order_funnel,
    "operations_5_city_monthly_revenue": operations.city_monthly_revenue,
    "operations_6_refund_leakage": operations.refund_leakage,
    "i14_tickets_by_status": operations.tickets_by_status,
    "i35_order_values": operations.order_values,
    "i40_friday_zones": operations.friday_zones,
    "i40_friday_zones_105": partial(operations.friday_zones, ratio_percent=105),
    # platform
    "ex1_month_tiles": executive.month_tiles,
    "ex1_month_tiles_corrected": partial(executive.month_tiles, corrected=True),
    "ex2_gmv_trend": executive.gmv_trend,
    "ex3_unit_economics": executive.unit_economics,
    "ex4_new_and_returning": executive.new_and_returning,
    "ex4_new_and_returning_corrected": partial(executive.new_and_returning, corrected=True),
    "i18_moving_orders": executive.moving_orders,
    "i18_moving_orders_calendar": executive.moving_orders_calendar,
    "i20_monthly_growth": executive.monthly_growth,
    "i24_platform_revenue_trend": executive.platform_revenue_trend,
    "i37_daily_growth": executive.daily_growth,
    "i37_daily_growth_corrected": partial(executive.daily_growth, corrected=True),
    "i43_daily_retention": executive.daily_retention,
    "ru1_platform_kpis": executive.platform_kpis,
    "nb4_platform_overview": executive.platform_overview,
    "nb5_recent_trend": executive.recent_trend,
    "nb9_month_start_growth": executive.month_start_growth,
    # questions
    "i1_orders_per_city": questions.orders_per_city,
    "i3_value_by_payment": questions.value_by_payment,
    "i4_never_ordered": questions.never_ordered,
    "i4_never_ordered_1995": partial(questions.never_ordered, until=date(1995, 7, 1)),
    "i4_dormant": questions.dormant,
    "i6_partners_by_vehicle": questions.partners_by_vehicle,
    "i9_promotion_usage": questions.promotion_usage,
    "i12_orders_by_hour": questions.orders_by_hour,
    "i13_big_spenders": questions.big_spenders,
    "i19_food_explorers": questions.food_explorers,
    "i21_seasoned_partners": questions.seasoned_partners,
    "i21_seasoned_partners_50": partial(questions.seasoned_partners, min_deliveries=50),
    "i23_active_every_month": questions.active_every_month,
    "i23_active_every_month_2": lambda m, as_of: questions.active_every_month(m, days_before(as_of, 2), months=2),
    "i25_above_own_average": questions.above_own_average,
    "i30_first_and_last": questions.first_and_last,
    "i30_first_and_last_all": partial(questions.first_and_last, k=None),
    "i38_more_in_second_quarter": questions.more_in_second_quarter,
    "nb6_status_distribution": questions.status_distribution,
    "rd1_demand_by_day_name": questions.demand_by_day_name,
    # reports
    "ru2_peak_cells": reports.peak_cells,
    "ru3_top_restaurants": reports.top_restaurants,
    "ru4_rfm_segments": reports.rfm_segments,
    "ru5_delivery_profiles": reports.delivery_profiles,
    "ru6_churn_segments": reports.churn_segments,
    "nb2_rfm_distribution": reports.rfm_distribution,
    "nb3_recency_revenue": reports.recency_revenue,
    "nb7_demand_heatmap": reports.demand_heatmap,
    "nb7_demand_pivot": reports.demand_pivot,
    "nb10_valuable_at_risk": reports.valuable_at_risk,
    # indicators
    "k1_revenue_metrics": kpis.revenue_metrics,
    "k2_customer_metrics": kpis.customer_metrics,
    "k3_acquisition_cost": kpis.acquisition_cost_flat,
    "k4_delivery_metrics": kpis.delivery_metrics,
    "k5_restaurant_metrics": kpis.restaurant_metrics,
    "k6_ticket_sla": kpis.ticket_sla,
    "k6_assignment_sla": kpis.assignment_sla,
    "k7_rfm_by_dictionary": kpis.rfm_by_dictionary,
    "k8_month_to_date": kpis.month_to_date,
    "k9_late_share_of_partners": kpis.late_share_of_partners,
    "k9_demand_colors": kpis.demand_colors,
    "k9_tier_colors": kpis.tier_colors,
    "k10_best_and_worst_partners": kpis.best_and_worst_partners,
    "k10_trips_per_day_histogram": kpis.trips_per_day_histogram,
    "k10_earnings_by_vehicle": kpis.earnings_by_vehicle,
    "k11_zone_alerts": kpis.zone_alerts,
    "k12_value_histogram": kpis.value_histogram,
    "k12_order_value_by_channel": kpis.order_value_by_channel,
    "k12_rating_trend": kpis.rating_trend,
    "k12_rating_against_orders": kpis.rating_against_orders,
    "k12_health_distribution": kpis.health_distribution,
    "k13_revenue_by_day": partial(kpis.revenue_metrics, grain="day"),
    "k13_revenue_by_week_payment": partial(kpis.revenue_metrics, grain="week", by=("payment_method",)),
    "k13_revenue_by_month_city": partial(kpis.revenue_metrics, grain="month", by=("city",)),
    "k13_revenue_by_month_cuisine": partial(kpis.revenue_metrics, grain="month", by=("cuisine",)),
    "k13_revenue_ytd_restaurant": partial(kpis.revenue_year_to_date, by=("restaurant",)),
    "i36_segments_with_revenue": kpis.segment_with_revenue,
    # data quality
    "d1_d2_keys": quality.validate_keys,
    "d3_references": quality.validate_references,
    "d4_d9_row_rules": quality.validate_rows,
    "d10_d13_business_rules": quality.validate_business,
    "d11_illegal_transitions": quality.illegal_transitions,
    # requests
    "x3_placed_orders": lambda m, as_of: _placed(m).orders,
    "x3_placed_items": lambda m, as_of: _placed(m).items,
    "x3_placed_payments": lambda m, as_of: _placed(m).payments,
    "x3_rejects": lambda m, as_of: _placed(m).rejects,
    "x4_cancelled_orders": lambda m, as_of: requests.cancel_orders(m, asked.cancel_requests(m)).orders,
    "x4_refunds": lambda m, as_of: requests.cancel_orders(m, asked.cancel_requests(m)).payments,
    "x4_rejects": lambda m, as_of: requests.cancel_orders(m, asked.cancel_requests(m)).rejects,
    "x5_refunds": lambda m, as_of: requests.process_refunds(m, asked.refund_requests(m)).payments,
    "x5_rejects": lambda m, as_of: requests.process_refunds(m, asked.refund_requests(m)).rejects,
    "x6_restaurant_ratings": requests.restaurant_ratings,
    "x7_assigned": lambda m, as_of: requests.assign_partners(m, requests.waiting_orders(m)).deliveries,
    "x7_orders": lambda m, as_of: requests.assign_partners(m, requests.waiting_orders(m)).orders,
    "x7_partners": lambda m, as_of: requests.assign_partners(m, requests.waiting_orders(m)).partners,
    "x7_rejects": lambda m, as_of: requests.assign_partners(m, requests.waiting_orders(m)).rejects,
    "x8_completed": lambda m, as_of: requests.complete_deliveries(m, asked.completion_requests(m)).deliveries,
    "x8_orders": lambda m, as_of: requests.complete_deliveries(m, asked.completion_requests(m)).orders,
    "x8_partners": lambda m, as_of: requests.complete_deliveries(m, asked.completion_requests(m)).partners,
    "x8_rejects": lambda m, as_of: requests.complete_deliveries(m, asked.completion_requests(m)).rejects,
    # running totals, batch and streaming
    "t1_restaurant_ratings": feeds.batch_restaurant_ratings,
    "t1_restaurant_ratings_stream": feeds.stream_restaurant_ratings,
    "t2_partner_ratings": feeds.batch_partner_ratings,
    "t2_partner_ratings_stream": feeds.stream_partner_ratings,
    "t3_audit_log": feeds.batch_audit_log,
    "t3_audit_log_stream": feeds.stream_audit_log,
    "t4_customer_totals": feeds.batch_customer_totals,
    "t4_customer_totals_stream": feeds.stream_customer_totals,
    "t5_restaurant_totals": feeds.batch_restaurant_totals,
    "t5_restaurant_totals_stream": feeds.stream_restaurant_totals,
    "t6_promotion_usage": feeds.batch_promotion_usage,
    "t6_promotion_usage_stream": feeds.stream_promotion_usage,
    "t7_partner_totals": feeds.batch_partner_totals,
    "t7_partner_totals_stream": feeds.stream_partner_totals,
    "t8_live_monitor": feeds.batch_live_monitor,
    "t8_live_monitor_stream": feeds.stream_live_monitor,
    "t9_hourly_demand": feeds.batch_hourly_demand,
    "t9_hourly_demand_stream": feeds.stream_hourly_demand,
    "t9_smoothed_demand": feeds.batch_smoothed_demand,
    "t9_smoothed_demand_stream": feeds.stream_smoothed_demand,
    # loading, storing, refreshing, reporting
    "s1_csv_round_trip": stored.csv_round_trip,
    "s10_inserted_customers": stored.inserted_customers,
    "s11_filled_zones": stored.filled_zones,
    "s12_table_sizes": stored.table_sizes,
    "s15_report_run": stored.report_run,
    "s16_order_store": stored.order_store,
    "s18_refreshed_views": stored.refreshed_views,
    "s19_after_load": stored.after_load,
    "f21_name_search": stored.name_search,
    "f21_indexed_search": stored.indexed_search,
    "g1_global_order": stored.global_order,
    "t3_first_status": feeds.batch_first_status,
    "t3_first_status_stream": feeds.stream_first_status,
    "t8_unassigned_orders": feeds.unassigned_orders,
}


def as_numbers(df: DataFrame) -> DataFrame:
    """Decimals as doubles, for consumers that compare plain numbers."""
    return df.select(*[
        F.col(f"`{f.name}`").cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType)
        else F.col(f"`{f.name}`") for f in df.schema.fields])
