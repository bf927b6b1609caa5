"""Operators for cleaning and packing a text corpus, one module each; ``queries`` registers them."""
