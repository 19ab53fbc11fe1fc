"""Batch deliveries to typed tables and daily marts, as Spark plans."""
