"""The seat-auction domain on its own tables: pages, dimensions, classes, results, features, multipliers, and the run over all of them."""
