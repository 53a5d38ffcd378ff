"""Named queries over the test tables, with independent SQL for each."""
