"""Vessel-position analytics as Spark DataFrame jobs.

Sub-packages: ``functions`` (column expressions), ``sources`` (scans and sinks),
``operators`` (frame-to-frame steps), ``plans`` (whole jobs), ``streaming``.
"""
