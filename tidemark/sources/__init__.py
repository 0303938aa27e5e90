"""Readers and writers: labelled CSV, message logs, API pages, collections."""
