"""Plan shapes shared by the operators: skew, paging, size checks, batches."""
