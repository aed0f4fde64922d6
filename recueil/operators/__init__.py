"""DataFrame operators: cleaning, profiling, merging, embedding, search."""
