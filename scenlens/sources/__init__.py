"""Query-table catalog, files and sinks."""
