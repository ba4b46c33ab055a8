"""Named datasets: query functions that read one another by name and are published as tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame

from millrace.sources.tables import Tables


class Datasets:
    """``@ds.dataset("name", expects={...}, expects_or_fail={...})`` declares, ``ds.read`` uses.

    Reading a dataset materializes it once per ``refresh`` round; upstream datasets follow by plain
    function calls.  Violations of ``expects`` are counted while the table is written and kept with its
    version (``ds.report``), those of ``expects_or_fail`` raise before the new version becomes visible.
    """

    def __init__(self, tables: Tables):
        self.tables = tables
        self._made: dict[str, tuple[Callable[[], DataFrame], str | None, dict, dict]] = {}
        self._fresh: set[str] = set()

    def dataset(
        self,
        name: str,
        comment: str | None = None,
        expects: Mapping[str, str] | None = None,
        expects_or_fail: Mapping[str, str] | None = None,
    ):
        def put(fn: Callable[[], DataFrame]):
            self._made[name] = (fn, comment, dict(expects or {}), dict(expects_or_fail or {}))
            return fn

        return put

    def read(self, name: str) -> DataFrame:
        if name not in self._fresh:
            self._publish(name)
        return self.tables.read(name)

    def refresh(self, name: str) -> DataFrame:
        self._fresh.clear()
        return self.read(name)

    def _publish(self, name: str) -> None:
        fn, comment, kept, failing = self._made[name]
        self.tables.overwrite(name, fn(), comment=comment, expects=failing, watch=kept)
        self._fresh.add(name)

    def report(self, name: str) -> dict[str, int]:
        """Violations counted when the current version of a dataset was written."""
        return self.tables.violations(name)
