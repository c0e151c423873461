"""Registered queries: one Spark plan and, where SQL can say it, one equivalent SQL text each."""
