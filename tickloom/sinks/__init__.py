"""Writers that can be run again without doubling their rows."""
