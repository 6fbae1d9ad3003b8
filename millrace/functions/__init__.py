"""Column functions for text, JSON, XML and binary decimals."""
