"""Raw-file readers, landing tables and sinks."""
