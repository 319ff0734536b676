"""Relational operators over populations, features, scores and labels."""
