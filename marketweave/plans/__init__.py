"""The stages of a listing run, composed from the operators."""
