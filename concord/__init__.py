"""Set-at-a-time reconciliation of account data and text corpora on Spark."""
