"""Query registry and end-to-end job plans."""
