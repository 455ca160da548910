"""Jobs: the named queries, view refresh and report runs."""
