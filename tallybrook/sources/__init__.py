"""Sources: raw statements as grids, ledgers and rule tables."""
