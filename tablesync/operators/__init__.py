"""DataFrame operators: diff, copy, validate, manifest, state, properties, views, backup."""
