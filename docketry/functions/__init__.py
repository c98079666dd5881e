"""Column-to-column functions: text, markup, maps, links and predicates."""
