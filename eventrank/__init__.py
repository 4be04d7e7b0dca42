"""eventrank: clean session data, build leakage-safe features per competitor and event, rank, score and report."""
