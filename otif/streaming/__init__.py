"""Streaming entry points.

The analytics this package reproduces are batch-only: every run replaces a full
snapshot and lateness is a business-date comparison, not event time. There is
therefore no streaming operator here; the batch pipeline in ``otif.plans`` is
the only execution path.
"""
