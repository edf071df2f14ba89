"""Business questions composed from the operators."""
