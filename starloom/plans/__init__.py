"""The jobs: conform feeds, model the star, check it, run a day."""
