"""Every operator bound to the driver tables, with the SQL that checks it."""

from __future__ import annotations

from tradewind.catalog import business, quality, relational, scalars, sources, windows
from tradewind.catalog.entry import Entry

ENTRIES: dict[str, Entry] = {}
for _module in (business, relational, windows, quality, scalars, sources):
    for _entry in _module.ENTRIES:
        if _entry.key in ENTRIES:
            raise ValueError(f"duplicate key {_entry.key}")
        ENTRIES[_entry.key] = _entry
