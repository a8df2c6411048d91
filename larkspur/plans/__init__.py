"""Registered queries: each pairs a Spark plan over the given tables with its SQL check."""
