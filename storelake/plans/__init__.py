"""Model runner and analytic queries over the marts."""
