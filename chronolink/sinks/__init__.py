"""sinks of chronolink."""
