"""Where events come from: log files, a replication stream, and bytes made from rows."""
