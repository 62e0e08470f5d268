"""Readers, schemas and sinks of tournament documents, and calls of the services they come from."""

from .calls import PayloadSource, PollSource, Poster, answers, discovered, fetched_files, origin_of
from .documents import binary_pages, landing, lookup, read_documents, read_stored, replace_documents, write_indexes
from .schemas import ENTRY, TOURNAMENT
from .store import Store, scratch_folder, written

__all__ = [n for n in dir() if not n.startswith("_")]
