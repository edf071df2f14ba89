"""One catalog line: an operator bound to the driver tables, and its SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from tradewind.catalog.sql import with_views
from tradewind.catalog.views import Retail


@dataclass(frozen=True)
class Entry:
    id: str
    key: str
    build: Callable[[Retail], DataFrame]
    sql: str | None = None

    def run(self, spark, folder: str) -> DataFrame:
        return self.build(Retail(spark, folder))

    def oracle(self) -> str | None:
        return with_views(self.sql) if self.sql else None
