"""Jobs: they run, write and record in the ledger."""
