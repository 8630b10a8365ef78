"""Layered (bronze, silver, gold) analytics tables built with plain PySpark."""
