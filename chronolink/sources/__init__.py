"""sources of chronolink."""
