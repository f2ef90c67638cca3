"""DataFrame operators. Keys stay on every frame; nothing is aligned by row position."""
