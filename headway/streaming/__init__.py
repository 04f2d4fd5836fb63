"""Structured Streaming jobs.

Sinks write one part per micro-batch and overwrite it when the batch is repeated, and every lookup
of stored state leaves out the parts of the running batch and later ones. So a batch that is
repeated after a failure ends with the same result.
"""
