"""Column functions: text masks, vector arithmetic, small expressions."""
