"""Footfall: station visit and flow analytics expressed as Spark DataFrame jobs."""
