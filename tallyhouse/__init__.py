"""Batch analytics on retail transaction lines, as Spark plans."""
