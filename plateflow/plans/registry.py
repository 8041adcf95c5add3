"""Reports by name."""

from __future__ import annotations

from plateflow.operators.calculated import calculated_fields
from plateflow.plans import categories, devices, health, hours, items, sessions

# The suite that runs when no names are given.
CORE_REPORTS = ("popular_items", "hourly_trends", "category_analysis", "device_breakdown")

# Reports over the event table.
REPORTS = {
    "popular_items": items.popular_items,
    "hourly_trends": hours.hourly_trends,
    "category_analysis": categories.category_analysis,
    "device_breakdown": devices.device_breakdown,
    "category_conversion": categories.category_conversion,
    "calculated_fields": calculated_fields,
    "item_interactions": items.item_interactions,
    "revenue_by_item": items.revenue_by_item,
    "heatmap": hours.heatmap,
    "events_by_category": categories.events_by_category,
    "category_event_breakdown": categories.category_event_breakdown,
    "revenue_kpi": categories.revenue_kpi,
    "events_by_device": devices.events_by_device,
    "restaurant_device_pivot": devices.restaurant_device_pivot,
    "device_daily_trend": devices.device_daily_trend,
    "category_daily_views": categories.category_daily_views,
    "hourly_profile": hours.hourly_profile,
    "device_platform_mix": devices.device_platform_mix,
    "device_dropoff": devices.device_dropoff,
    "session_funnel": sessions.session_funnel,
    "clock_skew": health.clock_skew,
    "late_arrivals": health.late_arrivals,
}

# Reports over validated payloads, accepted and rejected.
INGEST_REPORTS = {
    "ingest_summary": health.ingest_summary,
    "rejection_summary": health.rejection_summary,
    "ingest_rate_5min": health.ingest_rate_5min,
    "ingest_error_alarm": health.ingest_error_alarm,
}
