"""Column expressions shared by the marts: keys, masks, ladders, dates."""
