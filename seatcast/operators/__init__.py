"""Operators: lazy ``DataFrame -> DataFrame`` functions.

* ``staging``  cleaned snapshot view and per-event price history
* ``marts``    price curves, weekday windows, sell-out velocity, z-score anomalies
* ``alerts``   newest-day checks: price targets, anomalies, rule marking, digests
* ``reports``  the explorer/report queries with optional filters and summaries
* ``textmatch`` exact case-insensitive "contains" join without pair enumeration
"""
