"""Training-data operators; ``queries`` registers them."""
