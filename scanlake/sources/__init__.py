"""Readers and writers: file listings, page images, ledger tables, documents."""
