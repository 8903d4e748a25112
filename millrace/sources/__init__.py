"""Readers: every source gives a lazy DataFrame."""
