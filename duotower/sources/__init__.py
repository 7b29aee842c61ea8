"""Sources and sinks: ratings scans, sharded export + manifest, model store, run tables."""
