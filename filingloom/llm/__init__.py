"""Training-data operators: scoring, tokenising, formatting, sanitising, searching, mixing, joining."""
