"""Operators over observations: choice, conflicts, reviews, adoption, captures and storage."""
