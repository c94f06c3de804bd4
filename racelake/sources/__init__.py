"""Where rows come from and go to: tables, generators and stored pages."""
