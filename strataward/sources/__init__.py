"""Dataset catalog, readers, writers and stored layout."""
