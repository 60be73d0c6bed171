"""Query operators, each a lazy plan."""
