"""Registered queries on the shared tables, each with its SQL where SQL can express it."""

from __future__ import annotations

from . import clustering, exploration, files, membership, samples, sql_texts, streams, windows
from .registry import Query

ALL: dict[str, Query] = {
    **exploration.QUERIES,
    **membership.QUERIES,
    **windows.QUERIES,
    **samples.QUERIES,
    **clustering.QUERIES,
    **streams.QUERIES,
    **files.QUERIES,
    **sql_texts.QUERIES,
}
