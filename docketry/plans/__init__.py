"""Record and request jobs composed from the functions and operators."""
