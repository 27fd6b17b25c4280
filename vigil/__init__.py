"""vigil: transaction-anomaly analytics as Spark DataFrame operators.

Feature derivation, fitting, scoring and the analyst queries over the
scored table are expressed with the DataFrame API so Catalyst plans them;
a few order-dependent primitives (global rank, prefix sums, exact
quantiles) are composed from range partitioning plus Arrow-batched
per-partition passes.
"""

__version__ = "0.1.0"
