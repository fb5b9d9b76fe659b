"""Driver-side parts of a run: registry, manifests, outputs, command line."""
