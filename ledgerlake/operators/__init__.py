"""DataFrame -> DataFrame operators of the receivables ledger."""
