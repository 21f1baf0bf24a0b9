"""Writers. Every write is distributed; a single output file is opt-in."""
