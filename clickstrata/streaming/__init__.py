"""Structured Streaming forms of the operators.

Functions that take ``df`` work on a streaming and on a static DataFrame alike:
the static call is the batch twin used to check the stream.
"""
