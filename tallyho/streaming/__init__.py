"""Structured Streaming: the trailing-count processor, sliding-window counts,
the leaderboard sink, the stream application, and the landing runner used by
the registered stream queries."""
