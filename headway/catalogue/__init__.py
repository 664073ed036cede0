"""Every operator as a query over the test tables, with the same question in plain SQL."""
