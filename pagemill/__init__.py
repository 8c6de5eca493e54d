"""Spark jobs for saved forum pages, their links, and the message threads in them."""
