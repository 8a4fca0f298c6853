"""Layered lakehouse analytics on PySpark: landing, bronze, silver, gold star, marts and KPIs."""
