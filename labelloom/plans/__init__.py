"""Whole label plans: typed logs in, label rows out."""
