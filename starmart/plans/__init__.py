"""Query plans: the dashboard queries and the star-schema build."""
