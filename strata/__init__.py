"""strata: a three-layer (raw / clean / model) retail warehouse built on PySpark.

Layers
------
raw    all-text tables exactly as ingested, plus a stored ingest position
clean  trimmed, typed, deduplicated tables; bad values become NULL
model  a star schema: seven dimensions, four facts, one product key map

Every operator takes and returns DataFrames. Nothing is collected to the
driver except row counts used for size checks and the load audit.
"""

from strata.session import build_session, ensure_checkpoint_dir

__all__ = ["build_session", "ensure_checkpoint_dir"]
