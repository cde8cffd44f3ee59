"""DataFrame operators, grouped by the question they answer."""
