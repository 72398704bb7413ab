"""Readers and writers. Every reader is a file step plus a pure column step."""
