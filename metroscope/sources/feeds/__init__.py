"""One module per family of feeds: raw files in, clean table out."""
