"""The rollups as Structured Streaming queries."""
