"""The same pipeline on streams.

Three queries, joined by tables (or topics) and each with its own checkpoint: ETL routes raw reports to
``enriched`` and ``quarantine``; detection and cell crossings each read ``enriched``. Nothing flows back.
Every sink writes under the number of its micro-batch, so a replay overwrites its own output.
"""
