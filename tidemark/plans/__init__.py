"""Composed plans: staging, curation, the end-to-end medallion run, and the
registry of named queries over the supplied tables."""
