"""Readers and writers of tiles and packs, and of feeds."""
