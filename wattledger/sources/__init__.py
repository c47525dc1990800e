"""Readers for the archive, the daily files, the dimension and the message stream."""
