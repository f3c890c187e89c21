"""The registered queries and, written independently in another dialect, what they should give."""
