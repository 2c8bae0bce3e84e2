"""Reading inputs, writing results."""
