"""What the guard has granted so far, per product.

Each batch writes what it took.  Every ``SUM_EVERY`` batches all of it is added up into a table of totals, so a batch
reads one sum and a few batches, however long the stream has run.  A sum follows from the batches it covers, and a missing
one just makes the next batches read further back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storeflow.sources.commits import Part

SUM_EVERY = 16
# Stream name under which sums are logged, after the name of the stream they belong to.
TOTALS = "totals-of-"


def newest_total(parts: list[Part], source: str, before: int) -> int:
    """Last batch that a sum below ``before`` covers, or -1."""
    return max((p.batch_id for p in parts if p.source == TOTALS + source and p.batch_id < before), default=-1)


def reserved_before(store, source: str, batch_id: int) -> DataFrame:
    """(product_id, reserved): what earlier batches took."""
    sums, taken = store.parts("reservation_totals"), store.parts("reservations")
    start = newest_total(sums, source, batch_id)
    rows = store.rows_of([p for p in sums if (p.source, p.batch_id) == (TOTALS + source, start)], "reservation_totals")
    later = [p for p in taken if p.source == source and p.rows and start < p.batch_id < batch_id]
    rows = rows.unionByName(store.rows_of(later, "reservations"))
    return rows.groupBy("product_id").agg(F.sum("reserved").alias("reserved"))


def write_totals(store, source: str, batch_id: int, every: int | None = None) -> None:
    """Add up everything through ``batch_id`` if it is its turn."""
    if (batch_id + 1) % (every or SUM_EVERY) == 0:
        store.append(reserved_before(store, source, batch_id + 1), "reservation_totals", TOTALS + source, batch_id)
