"""Checkpointed streaming queries: landing events, and keeping dashboards current."""
