"""Sources and sinks: driver-table adapter, date-pruned scans, table writers."""
