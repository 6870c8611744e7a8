"""Retail behaviour analytics on Spark: sessions, categories, page flows, regions and ad clicks."""
