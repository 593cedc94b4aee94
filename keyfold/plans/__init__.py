"""Named query plans: the batch pipeline route, analytics, and the query catalog."""
