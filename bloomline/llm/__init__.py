"""Training-data operators: each takes and returns DataFrames; nothing else in the library imports them."""
