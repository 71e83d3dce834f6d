"""Changelog operators: normalising, rolling, collapsing, folding, applying."""
