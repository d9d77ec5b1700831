"""Stored user views that may read published models and each other.

A catalog is a folder of definitions, one row (name, sql, version) for each change.
The last version of a name counts; one without SQL takes the view away.  Definitions
may come in any order: ``register`` reads the names each query uses from Spark's
parser, builds the published models among them, and registers the views so that
each comes after those it reads.
"""

from __future__ import annotations

import time
import uuid
from collections import Counter
from collections.abc import Iterable
from graphlib import CycleError, TopologicalSorter

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import checkpoint_dir
from . import views
from .views import ViewRuleError

SCHEMA = "name string, sql string, version long"


class ViewCatalog:
    """``folder``: on a file system that all share; None keeps the definitions in memory."""

    def __init__(self, spark: SparkSession, folder: str | None = None):
        self.spark, self.folder = spark, folder
        self.definitions: dict[str, str] = self._stored() if folder else {}

    def _stored(self) -> dict[str, str]:
        try:
            log = self.spark.read.schema(SCHEMA).parquet(self.folder)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return {}
        last = log.groupBy("name").agg(F.max_by(F.struct("sql"), "version").alias("last"))
        return {r["name"]: r["last"]["sql"] for r in last.collect() if r["last"]["sql"] is not None}

    def _log(self, changes: list[tuple[str, str | None]]) -> None:
        if self.folder:
            at = time.time_ns()
            rows = [(name, sql, at + i) for i, (name, sql) in enumerate(changes)]
            self.spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(self.folder)

    def define(self, definitions: dict[str, str]) -> None:
        """Add or replace views.  All are checked first, and none is stored if one is refused."""
        for name, sql in definitions.items():
            views.check_view(self.spark, name, sql)
            if name in views.published_names():
                raise ViewRuleError(f"a published model has this name: {name}")
        whole = self.definitions | definitions
        self._order(whole, whole)
        self._log(list(definitions.items()))
        self.definitions = whole

    def drop(self, name: str) -> None:
        """Take a view away; refused while another view reads it."""
        if name not in self.definitions:
            raise ViewRuleError(f"no such view: {name}")
        readers = [n for n, sql in self.definitions.items() if n != name and name in self.reads(sql)]
        if readers:
            raise ViewRuleError(f"{name} is read by {', '.join(sorted(readers))}")
        self._log([(name, None)])
        del self.definitions[name]
        self.spark.catalog.dropTempView(name)

    def reads(self, sql: str, known: Iterable[str] = ()) -> set[str]:
        """Names that a query reads, without those that its own WITH defines.  A WITH
        name that ``known`` holds too is refused: by name alone the two are one."""
        own = views.with_names(self.spark, sql)
        both = own & (set(known) | views.published_names())
        if both:
            raise ViewRuleError(f"WITH defines the name of a view: {', '.join(sorted(both))}")
        return {parts[-1].lower() for parts in views.relations(self.spark, sql)} - own

    def _order(self, definitions: dict[str, str], wanted: Iterable[str]) -> list[str]:
        """The wanted views and those below them, each after the ones that it reads."""
        graph: dict[str, set[str]] = {}
        todo = [n for n in wanted if n in definitions]
        while todo:
            name = todo.pop()
            if name not in graph:
                graph[name] = {n for n in self.reads(definitions[name], definitions) if n in definitions}
                todo += graph[name]
        try:
            return list(TopologicalSorter(graph).static_order())
        except CycleError as e:
            raise ViewRuleError(f"views read each other: {' -> '.join(reversed(e.args[1]))}") from None

    def order(self, names: Iterable[str] | None = None) -> list[str]:
        return self._order(self.definitions, self.definitions if names is None else names)

    def register(self, models, names: Iterable[str] | None = None, once: Iterable[str] = ()) -> list[str]:
        """Temporary views for ``names`` (default: all) and what they read, stored or
        published.  Views above a redefined one are registered anew by the same call.  The rows of those in ``once``
        are written here, see ``query``."""
        chosen = self.order(names)
        below = set().union(*(self.reads(self.definitions[n]) for n in chosen))
        views.register_models(models, below - set(chosen))
        for name in chosen:
            views.register_view(self.spark, name, self.definitions[name])
            if name in once:
                self._write_once(models, name)
        return chosen

    def _uses(self, texts: Iterable[str]) -> Counter:
        """How often the queries name each relation."""
        return Counter(parts[-1].lower() for sql in texts for parts in views.relations(self.spark, sql))

    def _write_once(self, models, name: str) -> None:
        """The view over a Parquet copy of its rows, so that several readers do not each compute it from the facts.
        ``models.release`` deletes the copy.  Rows that Parquet cannot hold stay a plan."""
        view = self.spark.table(name)
        plain = (T.StringType, T.BinaryType, T.BooleanType, T.DateType, T.TimestampType, T.NumericType)
        if len({c.lower() for c in view.columns}) < len(view.columns) or not all(
                isinstance(f.dataType, plain) for f in view.schema.fields):
            return
        path = f"{checkpoint_dir(self.spark).rstrip('/')}/view-{uuid.uuid4().hex}"
        models._written.append(path)
        view.write.parquet(path)
        self.spark.read.schema(view.schema).parquet(path).createOrReplaceTempView(name)

    def query(self, models, sql: str) -> DataFrame:
        """One query over published models and stored views; only what it reads is built, and a stored view
        that is read more than once is written once."""
        read = self.reads(sql, self.definitions)
        chosen = self.order(read & set(self.definitions))
        uses = self._uses([sql, *(self.definitions[n] for n in chosen)])
        self.register(models, chosen, {n for n in chosen if uses[n] > 1})
        views.register_models(models, read - set(self.definitions))
        return self.spark.sql(sql)
