"""DataFrame operators: projection, filters, schema alignment and paging."""
