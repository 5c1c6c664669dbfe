"""DataFrame operators: frames in, frame out."""
