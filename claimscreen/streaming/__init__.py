"""Streaming of claimscreen."""
