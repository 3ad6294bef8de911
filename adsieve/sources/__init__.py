"""Readers: driver tables, derived event fixtures, landed requests, topics."""
