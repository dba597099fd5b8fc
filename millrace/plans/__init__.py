"""Multi-operator plans: quality reports, reconciliation, the daily orders run."""
