"""Readers (S*) and writers (K*)."""
