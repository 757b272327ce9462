"""Complete queries: dashboard panels, archive reads and the query register."""
