"""Where rows come from and go to: text extracts, layer tables, and the sample-table adapter."""
