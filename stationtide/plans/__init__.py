"""Whole workflows: ingest, retrieve, products and checks."""
