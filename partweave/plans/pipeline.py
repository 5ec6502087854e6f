"""The whole integration: rebase owners, rewrite foreign keys in dependency
order, clean and bind.

Lazy and memoized per table: asking for one output computes only the
rebases and rewrites it depends on. Each owner is rebased on its raw rows
(its part offsets count raw rows); an owner that is also a child (encounter)
has its own foreign keys rewritten - and loses unmatched rows - before its
key map is used, so the children of a dropped encounter drop too.
"""

from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.bind import bind, write_table
from ..operators.broadcast import DEFAULT_MAX_BYTES, hashed
from ..operators.ids import KEYS_ONLY_MIN_EXTRA_COLUMNS, assign_ids, assign_ids_many, key_map, orig_name
from ..operators.keys import known_broadcast, orphans, rewrite_fk
from ..registry import CLAIMS, Registry
from ..session import stage_counted


class Pipeline:
    def __init__(
        self,
        tables: Mapping[str, DataFrame],
        registry: Registry = CLAIMS,
        method: str = "two_pass",
        how: str = "inner",
        on_duplicates: str = "fail",
        broadcast: str = "auto",
        hot_key_rows: int | None = None,
        parallel_jobs: int = 4,
        broadcast_max_bytes: int = DEFAULT_MAX_BYTES,
        number_owners_together: bool = False,
        num_partitions: int | None = None,
        prefilter: bool = False,
        max_group_rows: int = 1_000_000,
        keys_only_above: int = KEYS_ONLY_MIN_EXTRA_COLUMNS,
    ):
        unknown = set(tables) - set(registry.tables)
        if unknown:
            raise KeyError(f"tables not in the registry: {sorted(unknown)}")
        # Kept as given: a lazy mapping builds each input on first use.
        self.raw = tables
        self.reg = registry
        self.part = registry.part
        self.method = method
        self.how = how
        self.on_duplicates = on_duplicates
        self.broadcast = broadcast
        self.hot_key_rows = hot_key_rows
        self.parallel_jobs = max(1, parallel_jobs)
        self.broadcast_max_bytes = broadcast_max_bytes
        self.number_owners_together = number_owners_together
        self._rebased: dict[str, DataFrame] = {}
        self._keymaps: dict[str, DataFrame] = {}
        self._rows: dict[str, int] = {}
        self._rewritten: dict[str, DataFrame] = {}
        self._checked: set[str] = set()
        self.num_partitions = num_partitions
        self.prefilter = prefilter
        self.max_group_rows = max_group_rows
        self.keys_only_above = keys_only_above

    # -- stages ---------------------------------------------------------
    def source(self, table: str) -> DataFrame:
        """The input table, its part and key columns checked on first use
        (a lazy input is only built when a result needs it)."""
        df = self.raw[table]
        if table not in self._checked:
            _check_columns(table, df, self.raw, self.reg)
            self._checked.add(table)
        return df

    def rebased(self, owner: str) -> DataFrame:
        """Owner with ``Orig<id>`` and a new dense ``<id>``, from raw rows."""
        if owner not in self._rebased:
            self._keep(owner, *self._assign(owner))
        return self._rebased[owner]

    def _assign(self, owner: str, src: DataFrame | None = None):
        stats: dict = {}
        rb, km = assign_ids(
            self.source(owner) if src is None else src, self.reg.owners[owner], self.part, self.method,
            self.on_duplicates, num_partitions=self.num_partitions, stats=stats, broadcast_max_bytes=self.broadcast_max_bytes,
            max_group_rows=self.max_group_rows, keys_only_above=self.keys_only_above,
        )
        return rb, km, stats

    def _keep(self, owner: str, rb: DataFrame, km: DataFrame, stats: dict) -> None:
        self._rebased[owner] = rb
        if not self.reg.keys_of(owner):
            # Not a child itself: its key map is final now (the narrow staged
            # table), and its exact size is known.
            self._keymaps[owner] = km
            if "rows" in stats:
                self._rows[owner] = stats["rows"]

    def rebase_owners(self, owners: list[str] | None = None) -> None:
        """Rebase several owners at once: each is an independent Spark job, so
        they are submitted from a small thread pool and share the cluster."""
        todo = [o for o in (owners if owners is not None else list(self.reg.owners)) if o in self.raw and o not in self._rebased]
        if len(todo) > 1 and self._numbered_together(todo):
            return
        if len(todo) <= 1 or self.parallel_jobs == 1:
            for o in todo:
                self.rebased(o)
            return
        # Inputs are resolved here, one after another: a lazy input shared by
        # two owners is built once, not raced for by two threads.
        srcs = [self.source(o) for o in todo]
        with ThreadPoolExecutor(max_workers=min(self.parallel_jobs, len(todo))) as ex:
            done = list(ex.map(self._assign, todo, srcs))
        for o, (rb, km, stats) in zip(todo, done):
            self._keep(o, rb, km, stats)

    def _numbered_together(self, todo: list[str]) -> bool:
        """One numbering for all ``todo`` owners (see ``assign_ids_many``),
        when asked for, the default method applies and their key types agree.

        Opt-in: it suits many small owners whose key maps all broadcast. A big
        narrow owner is cheaper numbered whole (one range shuffle) than through
        its keys plus a join-back that would shuffle it again."""
        if not self.number_owners_together or self.method != "two_pass" or self.on_duplicates != "fail":
            return False
        types = {
            (self.source(o).schema[self.part].dataType.simpleString(), self.source(o).schema[self.reg.owners[o]].dataType.simpleString())
            for o in todo
        }
        if len(types) != 1:
            return False
        done = assign_ids_many(
            {o: (self.source(o), self.reg.owners[o]) for o in todo}, self.part, self.num_partitions, self.broadcast_max_bytes
        )
        for o, (rb, km, rows) in done.items():
            self._keep(o, rb, km, {"rows": rows})
        return True

    def _owners_needed(self, table: str, seen: set | None = None) -> set[str]:
        seen = set() if seen is None else seen
        if table in self.reg.owners:
            seen.add(table)
        for k in self.reg.keys_of(table):
            o = self.reg.owner_of(k)
            if o in self.raw and o not in seen:
                self._owners_needed(o, seen)
        return seen

    def key_map(self, id_col: str) -> DataFrame:
        owner = self.reg.owner_of(id_col)
        self.rebased(owner)
        if owner in self._keymaps:
            km = self._keymaps[owner]
        else:
            km = key_map(self.rewritten(owner), id_col, self.part)
        return km

    def key_map_rows(self, id_col: str) -> int | None:
        """Row count of a key map when already known (owners that are not
        children themselves), else None."""
        return self._rows.get(self.reg.owner_of(id_col))

    def rewritten(self, table: str) -> DataFrame:
        """Table with every foreign key rewritten (owners: also rebased)."""
        if table in self._rewritten:
            return self._rewritten[table]
        self.rebase_owners(sorted(self._owners_needed(table)))
        cur = self.rebased(table) if table in self.reg.owners else self.source(table)
        keys = [k for k in self.reg.keys_of(table) if self.reg.owner_of(k) in self.raw]
        for k in keys:
            km = self.key_map(k)
            cur = rewrite_fk(
                cur, km, k, self.part, self.how, self.broadcast, self.hot_key_rows, self.key_map_rows(k),
                self.broadcast_max_bytes, self.prefilter,
            )
        if keys and table in self.reg.owners and self.reg.children_of(self.reg.owners[table]):
            # It feeds later rewrites as well as the output: cut lineage once;
            # its exact size, observed during the write, sizes its key map.
            cur, self._rows[table] = stage_counted(cur, f"rewritten-{table}")
        self._rewritten[table] = cur
        return cur

    def orphans(self, table: str, id_col: str) -> DataFrame:
        """Rows of ``table`` (before its rewrites) that the ``id_col`` rewrite
        drops."""
        src = self.rebased(table) if table in self.reg.owners else self.source(table)
        km = self.key_map(id_col)
        return orphans(src, km, id_col, self.part, self.key_map_rows(id_col), self.broadcast, self.broadcast_max_bytes)

    def audit(self) -> DataFrame:
        """Per foreign key: (table_name, id_col, rows_in, orphans) - the
        child's input rows and how many of them that key's rewrite drops
        (NULL or unknown in the owner's part; for a cascaded key, an owner row
        that was itself dropped). One pass per child: its keys are looked up
        one after the other (left joins to distinct owner keys, so no row
        multiplies, repeated owner keys or not) and counted in one aggregate."""
        frames = []
        for child in self.reg.tables:
            keys = [k for k in self.reg.keys_of(child) if self.reg.owner_of(k) in self.raw]
            if child not in self.raw or not keys:
                continue
            src = self.rebased(child) if child in self.reg.owners else self.source(child)
            seen = src.select(self.part, *keys)
            for i, k in enumerate(keys):
                km = self.key_map(k).select(self.part, F.col(orig_name(k)).alias(k))
                km = (km.distinct() if self.on_duplicates == "keep" else km).withColumn(f"_hit{i}", F.lit(True))
                side = known_broadcast(km, self.key_map_rows(k), self.broadcast, self.broadcast_max_bytes)
                side = hashed(km, self.key_map_rows(k)) if side is km else side
                seen = seen.join(side, [self.part, k], "left")
            rows = F.count(F.lit(1))
            one = [
                F.struct(F.lit(child).alias("table_name"), F.lit(k).alias("id_col"), rows.alias("rows_in"), F.count_if(F.col(f"_hit{i}").isNull()).alias("orphans"))
                for i, k in enumerate(keys)
            ]
            frames.append(seen.agg(F.array(*one).alias("a")).select(F.inline("a")))
        return reduce(DataFrame.unionByName, frames)

    def output(self, table: str) -> DataFrame:
        """Final table: keys rewritten, old owner IDs dropped, parts bound."""
        df = self.rewritten(table)
        if table in self.reg.owners:
            df = df.drop(orig_name(self.reg.owners[table]))
        return bind(df, self.part, self.reg.ordered(table, [c for c in df.columns if c.lower() != self.part.lower()]))

    def outputs(self) -> dict[str, DataFrame]:
        return {t: self.output(t) for t in self.reg.tables if t in self.raw}

    def write(self, out_dir: str, max_records_per_file: int | None = None) -> dict[str, str]:
        """Write every output as Snappy Parquet to ``out_dir/<table>`` (a new
        directory per run)."""
        outs = self.outputs()
        paths = {t: f"{out_dir.rstrip('/')}/{t}" for t in outs}
        with ThreadPoolExecutor(max_workers=self.parallel_jobs) as ex:
            list(ex.map(lambda t: write_table(outs[t], paths[t], max_records_per_file=max_records_per_file), outs))
        return paths


def _check_columns(t: str, df: DataFrame, tables: Mapping[str, DataFrame], reg: Registry) -> None:
    """Fail early, naming the table, when a part or key column is missing
    (names compared without regard to case, as Spark resolves them)."""
    needed = [reg.part]
    if t in reg.owners:
        needed.append(reg.owners[t])
    needed += [fk.id_col for fk in reg.foreign_keys if fk.child == t and fk.owner in tables]
    have = {c.lower() for c in df.columns}
    missing = [c for c in needed if c.lower() not in have]
    if missing:
        raise KeyError(f"table {t!r} lacks column(s) {missing}")


def run(tables: dict[str, DataFrame], registry: Registry = CLAIMS, out_dir: str | None = None, **kw) -> dict[str, DataFrame]:
    """Rebase, rewrite and bind every table; write them if ``out_dir`` is given."""
    p = Pipeline(tables, registry, **kw)
    if out_dir:
        p.write(out_dir)
    return p.outputs()
