"""Sources: catalog discovery, snapshots, and the change-log data source."""
