"""Registered queries by group. Each module has QUERIES: name -> function (spark, sf_dir), and SQL: name -> equivalent SQL."""
