"""Facts, dimensions and registry frames by role."""
