"""The queries: each takes the posts and its arguments, and returns lazy results."""
