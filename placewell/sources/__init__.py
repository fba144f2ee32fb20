"""Landing, file ingest, stored tables and file listings."""
