"""DataFrame to DataFrame transformations; no input or output happens here."""
