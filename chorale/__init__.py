"""Chorale: who spoke when, and which face it was, as DataFrame operators keyed by recording."""
