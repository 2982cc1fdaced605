"""Named models composed from the operators."""
