"""Named datasets: a function that returns a frame, the names it reads, where its result is kept and what must hold of it."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from graphlib import TopologicalSorter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scorepipe.sources.tables import write_table


@dataclass
class Dataset:
    name: str
    build: Callable[..., DataFrame]
    comment: str = ""
    inputs: list[str] = field(default_factory=list)
    checks: dict[str, Column] = field(default_factory=dict)


class Registry:
    """Datasets by name. Refreshing builds the wanted ones after the ones they read.

    Tables go to the warehouse, or below ``folder``.
    """

    def __init__(self, spark: SparkSession, folder: str | None = None):
        self.spark, self.folder = spark, folder
        self.datasets: dict[str, Dataset] = {}
        self.found: dict[str, dict[str, int]] = {}

    def dataset(self, name: str, comment: str = "", inputs: Iterable[str] = (), checks: dict[str, Column] | None = None):
        """Decorator: register `build(*input_frames)`. Inputs that are not datasets are tables or views.

        ``checks`` are conditions that every row of the result should meet, by name.
        """

        def register(build):
            if name in self.datasets:
                raise ValueError(f"dataset {name} is already registered")
            self.datasets[name] = Dataset(name, build, comment, list(inputs), dict(checks or {}))
            return build

        return register

    def order(self, names: Iterable[str] | None = None) -> list[str]:
        """The wanted datasets and everything they depend on, dependencies first."""
        todo, graph = list(names if names is not None else self.datasets), {}
        while todo:
            n = todo.pop()
            if n in graph:
                continue
            if n not in self.datasets:
                raise KeyError(f"no dataset {n}")
            graph[n] = [i for i in self.datasets[n].inputs if i in self.datasets]
            todo += graph[n]
        return list(TopologicalSorter(graph).static_order())

    def refresh(self, names: Iterable[str] | None = None, as_tables: bool = True, strict: bool = False) -> dict[str, DataFrame]:
        """Rebuild datasets in dependency order, as tables or, unwritten, as lazy frames.

        Rows and failed checks are counted on the table as written, before it takes its name, so each layer is computed
        once. With ``strict`` a table whose rows fail a check is not replaced, and the refresh ends there.
        """
        built: dict[str, DataFrame] = {}
        for n in self.order(names):
            d = self.datasets[n]
            frame = d.build(*[built[i] if i in built else self.spark.read.table(i) for i in d.inputs])
            if as_tables:
                path = f"{self.folder.rstrip('/')}/{n}-{uuid.uuid4().hex}" if self.folder else None
                write_table(frame, n, comment=d.comment, path=path, accept=lambda staged, d=d: self._note(d, staged, strict))
                frame = self.spark.read.table(n)
            built[n] = frame
        return built

    def _note(self, d: Dataset, staged: str, strict: bool) -> None:
        failed = [F.count_if(~F.coalesce(c, F.lit(False))).alias(f"c{i}") for i, c in enumerate(d.checks.values())]
        seen = self.spark.read.table(staged).agg(F.count(F.lit(1)).alias("rows"), *failed).first()
        self.found[d.name] = {"rows": seen["rows"], **{name: seen[f"c{i}"] for i, name in enumerate(d.checks)}}
        bad = {name: self.found[d.name][name] for name in d.checks if self.found[d.name][name]}
        if strict and bad:
            raise ValueError(f"rows of {d.name} that fail a check: {bad}")

    def report(self) -> DataFrame:
        """(dataset, check, rows, failed) of the latest refresh of every table."""
        rows = [(n, name, f["rows"], f[name]) for n, f in self.found.items() for name in self.datasets[n].checks]
        return self.spark.createDataFrame(rows, "dataset STRING, check STRING, rows BIGINT, failed BIGINT")
