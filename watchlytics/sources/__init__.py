"""Reading source tables, landing files, loading and publishing them."""
