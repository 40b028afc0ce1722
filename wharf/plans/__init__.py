"""Batch plans of the jobs, and the query registry checked against SQL oracles."""
