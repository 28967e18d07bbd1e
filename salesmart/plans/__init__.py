"""Whole jobs: the batch over files, and the layers over a star schema."""
