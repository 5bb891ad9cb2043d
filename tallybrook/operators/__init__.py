"""DataFrame operators. Each takes a DataFrame and returns one; none collects rows."""
