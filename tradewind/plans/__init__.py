"""Complete queries: relational reports, document catalogue, data exploration."""
