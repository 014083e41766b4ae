"""Where data lies: bronze files, stage and quarantine, current versions, the ledger, the stream source."""
