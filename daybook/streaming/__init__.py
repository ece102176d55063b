"""Day tables kept up from streams."""
