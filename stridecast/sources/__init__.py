"""Where tables, streams and models come from and go to."""
