"""Column builders and the ordered-group helpers the operators share."""
