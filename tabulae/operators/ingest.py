"""New-files-only ingestion: a manifest minus a ledger of what is done."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulae.operators.lookups import DEFAULT_MAX_BROADCAST_ROWS, fits_broadcast


def new_only(manifest: DataFrame, ledger: DataFrame, on: str | list[str], overwrite: bool = False,
             max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """Rows of ``manifest`` whose key is not in ``ledger`` (all rows if ``overwrite``).

    Only the ledger's key columns travel.  A ledger proven small (bounded
    row count, duplicates are harmless to an anti join) is broadcast; a large
    one takes a shuffle anti join.
    """
    if overwrite:
        return manifest
    keys = [on] if isinstance(on, str) else list(on)
    done = ledger.select(*keys)
    if fits_broadcast(done, max_broadcast_rows):
        done = F.broadcast(done)
    return manifest.join(done, keys, "left_anti")
