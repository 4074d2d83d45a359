"""Operators that prepare text, vectors and web pages for training. Nothing outside this folder imports it."""
