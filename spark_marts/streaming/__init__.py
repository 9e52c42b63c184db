"""Summary rows as keyed JSON events: build, publish, replay, deduplicate, roll up."""
