"""Reading and writing maps, tables and registries."""
