"""Retail marts as Spark jobs: staging, joins, marts, upserts, checks and KPIs."""
