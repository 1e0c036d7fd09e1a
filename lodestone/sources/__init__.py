"""Where files, changes and index rows come from and go to."""
