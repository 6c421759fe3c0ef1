"""Multi-step jobs and the size checks they share."""
