"""Starting the daily run when source files arrive."""
