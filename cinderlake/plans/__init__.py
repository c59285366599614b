"""Warehouse plans: conforming, map layers, dashboards and analyses."""
