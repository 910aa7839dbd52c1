"""DataFrame to DataFrame operators of the batch plan."""
