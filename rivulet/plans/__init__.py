"""Query plans: the reference's programs and the registered query catalog."""
