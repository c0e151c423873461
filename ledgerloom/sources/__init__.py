"""Reading raw relations, historising them, and writing results."""
