"""Bronze, silver and gold tables and the reports on top of them."""
