"""operators of chronolink."""
