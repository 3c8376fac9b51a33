"""End-to-end runs, tuning, reports, and the registry of checked queries."""
