"""What all pipelines share: the tables they feed and building these anew beside themselves."""

from __future__ import annotations

import copy

from segflow.config import PipelineConfig
from segflow.sources.ledger import LedgerIngest
from segflow.streaming.tables import StreamTable


class Pipeline:
    """Streams, in stages, that feed the StreamTables among its attributes."""

    spark = None
    config: PipelineConfig

    def stages(self) -> list[list]:
        raise NotImplementedError

    def tables(self) -> list[StreamTable]:
        """All tables, dependents first."""
        raise NotImplementedError

    def by_ledger(self, table: StreamTable, path: str, **columns) -> None:
        """Append the landed files that the table's ledger does not hold."""
        LedgerIngest(self.spark, self.config, table, path, newest=self.config.newest_folders, **columns).run()

    def beside(self) -> Pipeline:
        """The same pipeline, feeding new generations of all its tables under names of their own."""
        twin = copy.copy(self)
        for name, value in vars(self).items():
            if isinstance(value, StreamTable):
                setattr(twin, name, value.beside())
        return twin

    def take_over(self, built: Pipeline) -> None:
        """Swap in the generations that `built` has made, the tables others are derived from first."""
        for table, new in reversed(list(zip(self.tables(), built.tables()))):
            table.take_over(new, self.spark, self.config)
