"""DataFrame-to-DataFrame operators: staging, latest row, facts, checks, ledger, models."""
