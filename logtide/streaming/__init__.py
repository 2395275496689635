"""logtide.streaming."""
