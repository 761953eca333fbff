"""End-to-end jobs and the named analytic queries."""
