"""Structured Streaming forms of the two jobs (A1, A3): the same operators, plus keyed state."""
