"""Where frames come from."""
