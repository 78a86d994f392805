"""Sources and sinks (operators A1-A10)."""
