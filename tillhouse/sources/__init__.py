"""Sources and sinks: driver-table adapter, JDBC reads, landing, watermark state."""
