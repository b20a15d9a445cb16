"""The user-level compositions: extract, dedupe and fetch planning."""
