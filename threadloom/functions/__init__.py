"""See the README for the operator inventory."""
