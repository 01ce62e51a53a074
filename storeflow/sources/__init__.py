"""Input streams, output streams and table stores."""
