"""Folder layout of a pipeline root (any Hadoop-compatible URI)."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Layout:
    root: str

    def _p(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    # Admin: configuration text, run log, file dispositions
    @property
    def admin(self) -> str: return self._p("Admin")
    @property
    def log(self) -> str: return self._p("Admin", "Log")
    @property
    def disposition(self) -> str: return self._p("Admin", "FileDisposition")
    @property
    def column_layouts(self) -> str: return self._p("Admin", "ColumnLayouts")
    @property
    def move_intents(self) -> str: return self._p("Admin", "MoveIntents")
    @property
    def move_outcomes(self) -> str: return self._p("Admin", "MoveOutcomes")
    @property
    def bridge(self) -> str: return self._p("Admin", "BrandCategoryProductServiceSeller")
    @property
    def silver_files(self) -> str: return self._p("Admin", "SilverFiles")
    @property
    def silver_keys(self) -> str: return self._p("Admin", "TransactionKeys")
    @property
    def gold_runs(self) -> str: return self._p("Admin", "GoldRuns")

    # Bronze
    @property
    def bronze_inbound(self) -> str: return self._p("Bronze", "Inbound")
    @property
    def bronze_archive(self) -> str: return self._p("Bronze", "Archive")
    @property
    def bronze_error(self) -> str: return self._p("Bronze", "Error")
    @property
    def bronze_transaction(self) -> str: return self._p("Bronze", "Transaction")
    @property
    def bronze_quarantine(self) -> str: return self._p("Bronze", "Error", "_rows")
    @property
    def to_map(self) -> str: return self._p("Bronze", "ToMap")

    # Silver
    def silver_dimension(self, name: str) -> str: return self._p("Silver", "Dimension", name)
    @property
    def silver_transaction(self) -> str: return self._p("Silver", "Facts", "Transaction")

    # Gold
    def gold_dimension(self, name: str) -> str: return self._p("Gold", "Dimensions", name)
    @property
    def gold_date(self) -> str: return self._p("Gold", "Dimensions", "Date")
    @property
    def gold_transaction(self) -> str: return self._p("Gold", "Facts", "Transaction")
    @property
    def gold_spend(self) -> str: return self._p("Gold", "Facts", "SpendByCategoryMonth")
    @property
    def gold_category_closure(self) -> str: return self._p("Gold", "Dimensions", "CategoryClosure")
    @property
    def gold_spend_tree(self) -> str: return self._p("Gold", "Facts", "SpendByCategoryTreeMonth")
