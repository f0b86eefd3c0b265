"""The tables of each layer, composed from operators."""
