"""Table definitions, CSV ingest, change logs and stored state."""
