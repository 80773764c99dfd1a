"""Warehouse-query telemetry as DataFrame operators.

One row per query that a warehouse ran: when it arrived, how long it queued,
compiled and executed, how much it scanned and spilled, and where it ran.
Every operator takes DataFrames and returns a DataFrame; those in
``tidegauge.streaming`` do the same on Structured Streaming.
"""
