"""streaming of chronolink."""
