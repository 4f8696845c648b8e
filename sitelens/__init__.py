"""sitelens — site-audit analytics on Spark DataFrames.

Every operator takes DataFrames (plus plain arguments) and returns a
DataFrame; only bounded scalars (a maximum id, per-partition counts, a
cut-off day, one-row checks) are ever read on the driver.

Where things are:

- ``sitelens.sources``      site lists (S1), stored responses (S2), metric JSON (S3),
                            table registration (S4)
- ``sitelens.operators``    assemble (T1-T3, Q5), filters (F1-F9, J2), metrics (A1-A15),
                            ranking (W1-W3, L1-L8), quarantine (J1, J3, W4, W5, U2-U5),
                            quality (Q1-Q4), sequence (distributed numbering)
- ``sitelens.functions``    scalar Column rules (X1-X14)
- ``sitelens.sinks``        Parquet / JSON / CSV outputs and appends (K1-K8, U1)
- ``sitelens.streaming``    incremental ingest with Structured Streaming (R1)
- ``sitelens.plans``        SQL with bound parameters (C1), the daily commands, and the
                            named reports with their SQL oracles
- ``sitelens.session``      session builder and the shared work folder
"""

__version__ = "0.1.0"
