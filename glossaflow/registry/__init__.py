"""Language registries and the joins over them."""
