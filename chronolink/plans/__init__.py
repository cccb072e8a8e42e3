"""plans of chronolink."""
