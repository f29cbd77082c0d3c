"""Scans: submission listings, files, archives, documents, manifests."""
