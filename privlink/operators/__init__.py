"""Composite operators: flatten, link, protect, analyse, lineage."""
