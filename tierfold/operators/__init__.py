"""DataFrame transformations between the layers."""
