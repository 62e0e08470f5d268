"""Documents, standings and indexes that follow changes: one batch of documents is one version of all tables."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..sources.store import Store
from . import indexes


def follow(store: Store, documents: DataFrame, batch: tuple[str, int] | None = None, dealt: bool = False, names: tuple[str, ...] | None = None) -> int:
    """Puts ``documents``, one row an openid, in: what their openids had in any table goes, and what they have now comes; the version.

    Only the rows of the batch are derived and written; indexes are derived from the documents' files, bucket by bucket, without a
    shuffle.  ``batch`` (stream, number) makes a repeated call change nothing.  ``dealt``: ``documents`` were shuffled by openid alone.
    ``names`` are the indexes of a new store, all by default; a store that is there goes on with those it has.
    """
    before = store.manifest()
    if batch and before["ledger"].get(batch[0], -1) >= batch[1]:
        return before["version"]
    has = tuple(name for name in indexes.INDEXES if name in before["tables"]) if "documents" in before["tables"] else names or tuple(indexes.INDEXES)
    written = store.stage("documents", documents, dealt=dealt)
    return store.apply({"documents": written, **indexes.build(written, has)}, keys=written, batch=batch, derived=True)


def rebuilt(store: Store, version: int | None = None) -> dict[str, DataFrame]:
    """The indexes of a version from its documents, to hold the maintained ones against."""
    return indexes.build(store.read("documents", version), tuple(name for name in indexes.INDEXES if name in store.manifest(version)["tables"]))
