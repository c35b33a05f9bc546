"""Typed, chunked, resumable file datasets on Spark."""
