"""Relational building blocks: range joins, rules, fees, FX, versions, checks."""
