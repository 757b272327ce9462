"""Where records come from: feeds, decoding, and archive reads."""
