"""Part of Velora."""
