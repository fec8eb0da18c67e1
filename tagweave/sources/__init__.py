"""Where rows come from: tables, JDBC, lexicon rule sets, pending runs."""
