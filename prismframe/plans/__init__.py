"""Plans that chain operators, and the session helpers they share."""
