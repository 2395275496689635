"""logtide.sources."""
