"""Scans: batch files, model replies, chat files, model outputs, document store, topics."""
