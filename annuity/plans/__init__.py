"""Composed plans: the settlement pipeline, the named queries and the job."""
