"""Named queries over the tables of a directory, with reference SQL where SQL can express them."""
