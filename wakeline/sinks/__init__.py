"""Sinks: lake, files, topic, landing tables and layer rebuilds."""
