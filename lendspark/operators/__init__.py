"""DataFrame operators: frames and column names in, a frame out."""
