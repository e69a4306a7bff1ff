"""Layer models composed from the operators."""
