"""Every operator as a query over the given tables, with matching SQL."""
