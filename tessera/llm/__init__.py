"""Operators for building training corpora from raw documents."""
