"""Readers of sequence, hit, metadata and work-queue files."""
