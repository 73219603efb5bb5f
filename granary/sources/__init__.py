"""File listings, configuration files and the files that operators end in."""
