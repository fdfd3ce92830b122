"""What a reader of a table may see: tagged columns, masked unless the reader's role is exempt from the tag.

``Access.view`` compiles a table and a role into one projection: a tagged
column is masked by its type, or clear if the role may see that type; a role
that is not known may see none.  ``Access.clear`` reads a view's plan and names
the tagged columns that come through as they are, and ``view`` refuses to hand
out a frame in which one does that must not.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from vaultline.functions.masking import MASK_RULES, mask_as

ALL = "*"


class AccessError(ValueError):
    """A table that lacks a tagged column, or a view that shows what it must not."""


@dataclass(frozen=True)
class Tag:
    layer: str
    table: str
    column: str
    pii_type: str


class Access:
    """``tags`` of all tables, and per role the types it sees clear (``*``: all)."""

    def __init__(self, tags: Sequence[Tag], exempt: Mapping[str, Collection[str]]) -> None:
        unknown = sorted({t.pii_type for t in tags} - {name for name, _ in MASK_RULES})
        if unknown:
            raise AccessError(f"no mask for {', '.join(unknown)}")
        named = [(t.layer, t.table, t.column) for t in tags]
        twice = sorted({".".join(n) for n in named if named.count(n) > 1})
        if twice:
            raise AccessError(f"tagged twice: {', '.join(twice)}")
        self.tags, self.exempt = list(tags), {role: set(types) for role, types in exempt.items()}

    def of(self, layer: str, table: str) -> dict[str, str]:
        """Tagged column -> type."""
        return {t.column: t.pii_type for t in self.tags if (t.layer, t.table) == (layer, table)}

    def hidden(self, layer: str, table: str, role: str) -> dict[str, str]:
        """Columns that ``role`` sees masked."""
        seen = self.exempt.get(role, set())
        return {c: t for c, t in self.of(layer, table).items() if ALL not in seen and t not in seen}

    def view(self, df: DataFrame, layer: str, table: str, role: str) -> DataFrame:
        """``df`` as ``role`` may see it; masked columns are strings, all others stay as they are."""
        missing = [c for c in self.of(layer, table) if c not in df.columns]
        if missing:
            raise AccessError(f"{layer}.{table} lacks {', '.join(missing)}")
        hidden = self.hidden(layer, table, role)
        out = df.withColumns({c: mask_as(c, t) for c, t in hidden.items()}) if hidden else df
        shown = sorted(set(self.clear(df, out, layer, table)) & set(hidden))
        if shown:
            raise AccessError(f"{layer}.{table} shows {', '.join(shown)} to {role}")
        return out

    def clear(self, source: DataFrame, view: DataFrame, layer: str, table: str) -> list[str]:
        """Tagged columns of ``source`` that ``view`` gives out unchanged, under any name (read from the analysed plan)."""
        given = _ids(view)
        for alias, own in _renamed(view):
            if alias in given:
                given.add(own)
        return [c for c, own in zip(source.columns, _ids(source, ordered=True)) if c in self.of(layer, table) and own in given]


def _each(sequence) -> list:
    return [sequence.apply(i) for i in range(sequence.size())]


def _ids(df: DataFrame, ordered: bool = False):
    """Expression ids of a frame's columns."""
    ids = [a.exprId().id() for a in _each(df._jdf.queryExecution().analyzed().output())]
    return ids if ordered else set(ids)


def _renamed(df: DataFrame) -> list[tuple[int, int]]:
    """(new id, old id) of plain renames in the outermost projections, outermost first."""
    found, plan = [], df._jdf.queryExecution().analyzed()
    while plan.nodeName() == "Project":
        for e in _each(plan.projectList()):
            if e.nodeName() == "Alias" and e.child().nodeName() == "AttributeReference":
                found.append((e.exprId().id(), e.child().exprId().id()))
        plan = plan.child()
    return found
