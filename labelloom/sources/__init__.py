"""Where the logs come from and how they are parsed."""
