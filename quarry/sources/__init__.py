"""Sources and sinks (inventory group A)."""
