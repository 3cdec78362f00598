"""Where rows and change records come from."""
