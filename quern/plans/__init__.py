"""Named queries over the project's tables, each with its SQL twin where SQL can say it."""
