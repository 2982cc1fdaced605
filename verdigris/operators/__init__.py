"""DataFrame transformations shared by the plans."""
