"""Plans of claimscreen."""
