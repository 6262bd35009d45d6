"""Structured Streaming jobs: change unwrap, landing, dead letters, apply, timelines."""
