"""Collections on shared storage."""
