"""The data model as parameters: tables, ID owners and foreign keys.

``CLAIMS`` is the nine-table claims model the engine was built for; any other
multi-part dataset is described by another ``Registry``.
"""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class ForeignKey:
    child: str
    id_col: str
    owner: str


@dataclass(frozen=True)
class Registry:
    tables: tuple[str, ...]
    # owner table -> the ID column it defines
    owners: dict[str, str]
    foreign_keys: tuple[ForeignKey, ...]
    part: str = "part"
    id_suffix: str = "id"
    # table -> leading columns of its output, in order; others follow as they came
    output_order: dict[str, tuple[str, ...]] = field(default_factory=dict)

    def owner_of(self, id_col: str) -> str:
        for t, c in self.owners.items():
            if c.lower() == id_col.lower():
                return t
        raise KeyError(id_col)

    def keys_of(self, table: str) -> list[str]:
        """Foreign keys of ``table``, in rewrite order, spelled as their owner spells them."""
        mine = {fk.id_col.lower() for fk in self.foreign_keys if fk.child == table}
        return [k for k in self.key_order() if k.lower() in mine]

    def children_of(self, id_col: str) -> list[str]:
        return [fk.child for fk in self.foreign_keys if fk.id_col.lower() == id_col.lower()]

    def ordered(self, table: str, columns: list[str]) -> list[str]:
        """``columns`` in the declared output order of ``table`` (names ignoring case)."""
        rank = {c.lower(): i for i, c in enumerate(self.output_order.get(table, ()))}
        return sorted(columns, key=lambda c: rank.get(c.lower(), len(rank)))

    def key_order(self) -> list[str]:
        """Owner IDs in an order where every owner's own foreign keys are
        rewritten before its ID is used (a stable topological sort: an owner
        that is also a child - like encounter - comes after its parents)."""
        deps = {
            t: {self.owner_of(fk.id_col) for fk in self.foreign_keys if fk.child == t and fk.owner != t}
            for t in self.owners
        }
        done: list[str] = []
        pending = list(self.owners)
        while pending:
            ready = [t for t in pending if deps[t] <= set(done)]
            if not ready:
                raise ValueError(f"foreign keys form a cycle among {pending}")
            done.append(ready[0])
            pending.remove(ready[0])
        return [self.owners[t] for t in done]


# The claims data model - table names, each owner and its ID
# column, and every (child, ID) foreign key.
CLAIMS = Registry(
    tables=(
        "death",
        "demographic",
        "diagnosis",
        "dispensing",
        "encounter",
        "enrollment",
        "procedure",
        "facility",
        "provider",
    ),
    owners={
        "demographic": "PatID",
        "provider": "ProviderID",
        "facility": "FacilityID",
        "encounter": "EncounterID",
    },
    foreign_keys=(
        ForeignKey("death", "PatID", "demographic"),
        ForeignKey("diagnosis", "PatID", "demographic"),
        ForeignKey("dispensing", "PatID", "demographic"),
        ForeignKey("encounter", "PatID", "demographic"),
        ForeignKey("enrollment", "PatID", "demographic"),
        ForeignKey("procedure", "PatID", "demographic"),
        ForeignKey("diagnosis", "ProviderID", "provider"),
        ForeignKey("dispensing", "ProviderID", "provider"),
        ForeignKey("procedure", "ProviderID", "provider"),
        ForeignKey("encounter", "FacilityID", "facility"),
        ForeignKey("diagnosis", "EncounterID", "encounter"),
        ForeignKey("procedure", "EncounterID", "encounter"),
    ),
)
