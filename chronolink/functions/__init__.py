"""functions of chronolink."""
