"""The views and reports: staging, business, metrics, alerts, KPIs, healthcare."""
