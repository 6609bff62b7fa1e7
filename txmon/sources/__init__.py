"""Where data comes from and goes to: raw files, layer tables, exchange rates."""
