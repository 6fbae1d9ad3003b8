"""Messages: envelope, validation, enrichment, and the streams that run them."""
