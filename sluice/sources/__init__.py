"""Sources: table and view scans, hwm windows, change logs, snapshots, staged files."""
