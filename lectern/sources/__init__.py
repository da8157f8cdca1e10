"""Readers: tables, plain text, normalised JSON, CSV policies, hint rules, HTML pages and Word files, all to block tables."""
