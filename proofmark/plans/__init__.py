"""Every runnable query with its SQL twin."""
