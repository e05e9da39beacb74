"""Named queries over the given tables, each with an equivalent SQL text where one exists."""
