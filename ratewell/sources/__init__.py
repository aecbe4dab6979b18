"""Reading landing data and dimensions, writing results."""
