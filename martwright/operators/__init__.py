"""DataFrame-to-DataFrame operators that know nothing about the commerce tables."""
