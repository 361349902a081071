"""Where rows come from: topics, static tables, files and batch tables."""
