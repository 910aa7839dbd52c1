"""Live arrivals: the tracker, its batch form and the consumers of its updates."""
