"""Payload to common rows: one pure function per dataset, from landing rows to typed rows.

Every function takes landing rows of one dataset for all symbols at once. Numbers, dates and names
go through the shared column functions; only HTML bodies pass through Python, to be parsed.
"""
