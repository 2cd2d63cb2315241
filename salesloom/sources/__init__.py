"""Readers that turn files of any layout into the grid model."""
