"""Sources and sinks: CSV folders, catalog tables, frames in memory, the star-schema mapping."""
