"""Where rows and groups are read from."""
