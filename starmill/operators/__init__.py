"""DataFrame operators the star build is made of."""
