"""Incremental runs over file folders."""
