"""Sources of claimscreen."""
