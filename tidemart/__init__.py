"""Dimensional warehouses from periodic series, as plain Spark DataFrame jobs.

Layers, from landed files to reports::

    sources    landed payloads, seeds and calendars as DataFrames
    loads      replace / append / merge into raw tables, incremental windows
    functions  column expressions shared by every layer
    operators  generic DataFrame operators (keys and columns are arguments)
    plans      the exchange-rate star schema built from those operators
    streaming  the same merge fed by a file stream
"""

from tidemart.session import build_session, work_dir

__all__ = ["build_session", "work_dir"]
