"""The operators composed into runnable queries, and independent SQL for each."""
