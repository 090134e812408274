"""DataFrame-to-DataFrame steps: clean, join, load, summarise, look up."""
