"""Curation of annotated-record datasets on Spark."""
