"""Where typed rows go: folders or catalog tables, with one replaceable slot per generation."""
