"""Retail price monitoring on Spark: land, check, clean, load and analyse price feeds."""
