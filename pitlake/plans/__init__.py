"""Registered queries, oracle SQL, driver-table adapters and the end-to-end pipeline."""
