"""Sources and sinks: fixture relations, table loading, CSV loads, publishing."""
