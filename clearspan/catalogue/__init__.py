"""Registered queries: the operators applied to the driver's tables, with oracle SQL."""
