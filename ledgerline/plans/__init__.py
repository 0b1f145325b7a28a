"""Reports: finance, sales, purchases and table models."""
