"""DataFrame operators over assets."""
