"""Complete reports and the query catalog."""
