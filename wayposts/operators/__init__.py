"""Building blocks of the queries: ``DataFrame`` in, lazy ``DataFrame`` out."""
