"""Jobs that cut, embed, rank and fuse."""
