"""Dossier: reconcile many messy record sources into one canonical profile per entity, on Spark."""
