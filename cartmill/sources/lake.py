"""Where each layer lives. The run date is always given, never taken from the clock."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date


@dataclass(frozen=True)
class Lake:
    root: str

    def incoming(self, source: str, run_date: date) -> str:
        """The drop folder's address of one raw document: YYYY/MM/DD/<source>.json."""
        return f"{self.root}/incoming/{run_date:%Y/%m/%d}/{source}.json"

    @property
    def bronze_root(self) -> str:
        return f"{self.root}/bronze"

    def bronze(self, source: str, run_date: date) -> str:
        return f"{self.bronze_root}/source={source}/run_date={run_date.isoformat()}"

    def silver_root(self, table: str) -> str:
        return f"{self.root}/silver/{table}"

    def silver(self, table: str, run_date: date) -> str:
        return f"{self.silver_root(table)}/run_date={run_date.isoformat()}"

    def gold(self, table: str) -> str:
        return f"{self.root}/gold/{table}"

    def load_folder(self, table: str, run_date: date, batch: str, root: str | None = None) -> str:
        """One load's own folder in a table of several loads (gold, unless `root` is given)."""
        return f"{root or self.gold(table)}/run_date={run_date.isoformat()}/batch={batch}"

    @property
    def ledger(self) -> str:
        """Units of line keys that loads have taken, an empty file each."""
        return f"{self.root}/ledger"

    def rejects(self, table: str) -> str:
        return f"{self.root}/rejects/{table}"

    def file_results(self, table: str) -> str:
        """What each load made of each silver file."""
        return f"{self.root}/results/{table}"

    def loaded_files(self, table: str) -> str:
        """Which silver files an append load has taken, a folder a load."""
        return f"{self.root}/loaded_files/{table}"

    def partials(self, table: str) -> str:
        """Results of each load that add up to those of all."""
        return f"{self.root}/partials/{table}"

    def report(self, name: str) -> str:
        return f"{self.root}/reports/{name}"

    def checkpoint(self, name: str) -> str:
        return f"{self.root}/checkpoints/{name}"
