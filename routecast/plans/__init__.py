"""Plans over the operators: warehouse build, named queries, semantic
metric API, batch reports."""
