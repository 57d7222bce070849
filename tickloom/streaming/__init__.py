"""Incremental runs: bars from a stream of events, and the ledger kept up session by session."""
