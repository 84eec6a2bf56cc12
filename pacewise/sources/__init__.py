"""Sources and sinks: the given tables, the derived ad-event fixture, lake tables, campaign snapshots."""
