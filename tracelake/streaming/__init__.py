"""Structured Streaming: traces as they land, and block completion as keyed state."""
