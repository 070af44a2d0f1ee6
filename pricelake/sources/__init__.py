"""Sources and sinks: driver-table bindings, bronze/silver/gold scans and
writers, and parsers for landed vendor payloads (JSON, XML, HTML, wide)."""
