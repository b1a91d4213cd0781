"""Column -> Column scalar functions (inventory section H, B8-B14)."""
