"""Named queries over the bundled star schema, each with its check SQL."""
