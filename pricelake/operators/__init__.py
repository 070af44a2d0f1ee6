"""DataFrame → DataFrame operators (silver, reconciliation, quality gate,
dimensions, facts, sampling, cross-checks)."""
