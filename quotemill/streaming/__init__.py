"""Structured Streaming: landed batches into keyed tables, bars, latest documents, repeat suppression."""
