"""User-behaviour labels on Spark: click, search and exposure logs in, one label row per user out."""
