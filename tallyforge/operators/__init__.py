"""DataFrame operators of the market lake."""
