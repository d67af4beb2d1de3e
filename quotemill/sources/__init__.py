"""Reading landed payloads, files and tables; writing files and snapshots."""
