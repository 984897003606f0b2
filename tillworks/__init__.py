"""Retail invoice lines refined through bronze, silver and gold layers, on Spark."""
