"""Query catalogue and multi-stage plans."""
