"""Part of termweave."""
