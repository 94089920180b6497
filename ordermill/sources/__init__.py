"""Reading, writing and auditing tables."""
