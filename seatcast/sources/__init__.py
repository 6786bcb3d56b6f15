"""Sources and sinks: driver tables, landed API pages, the snapshot store,
alert rules and the genre seed."""
