"""Readers and writers: driver tables, CSV landing area, partitioned tables."""
