"""Sources and sinks: fixture adapter over the star-schema tables, CSV readers, writers."""
