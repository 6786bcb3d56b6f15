"""seatcast: ticket price and availability analytics as plain Spark DataFrame functions.

Every public function takes DataFrames (and explicit parameters) and returns a
lazy DataFrame; nothing collects to the driver.  Sub-packages:

* ``sources``   readers/writers: driver-table adapter, landed API pages, the
                snapshot store, alert rules, the genre seed
* ``functions`` column expressions shared by all operators (rounding recipes,
                buckets, weekdays, z-scores)
* ``operators`` staging views, marts, alert checks and report queries
* ``plans``     whole jobs (materialise marts, run the alert check) and the
                query registry used by ``__spark_entry__``
* ``streaming`` incremental (Structured Streaming) snapshot ingestion
"""

__version__ = "0.1.0"
