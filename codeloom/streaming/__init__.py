"""Structured Streaming front-ends of the stateless event rules."""
