"""Monthly credit-risk reporting as Spark DataFrame jobs.

Layers: raw text -> Bronze (typed, one row per transaction) -> Silver (balances in THB, loan status, provision)
-> Gold (one KPI row per month), then quality checks, reconciliation, reports, diagnostics and a run log.
"""
