"""Where tables come from and go to: archives, text, snapshots, catalog."""
