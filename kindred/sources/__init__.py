"""Readers and writers: article corpora, keyword indexes, splits, reports."""
