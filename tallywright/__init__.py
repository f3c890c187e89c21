"""tallywright: ledger-to-payment-to-bank reconciliation and exception analytics on Spark."""
