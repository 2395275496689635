"""logtide.plans."""
