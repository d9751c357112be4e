"""Training-data operators: each works on a DataFrame of texts or pages and returns a DataFrame."""
