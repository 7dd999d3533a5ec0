"""Writers of final tables."""
