"""Sources: stored tables, landed records and payloads."""
