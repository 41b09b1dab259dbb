"""Compositions of operators: whole profiles, model frames, and batch stages."""
