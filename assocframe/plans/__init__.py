"""Plan shapes Catalyst does not find on its own."""
