"""Operators of claimscreen."""
