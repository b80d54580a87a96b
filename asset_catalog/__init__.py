"""Saved BI assets (queries, charts, dashboards, widgets) as Spark DataFrames."""
