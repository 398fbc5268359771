"""Named queries and whole flows, composed of operators."""
