"""DataFrame operators over readings, ticks and rules."""
