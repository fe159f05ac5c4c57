"""Query catalogue and pipeline composition."""
