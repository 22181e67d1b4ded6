"""The tags: each function returns one row per user with the id and the tag."""
