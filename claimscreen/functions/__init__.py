"""Functions of claimscreen."""
