"""Where rows are written to."""
