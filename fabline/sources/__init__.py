"""Sources and sinks: driver tables, adapters, message streams, files."""
