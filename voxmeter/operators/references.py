"""References to records that do not exist at the time they are used.

The tables form a graph of foreign keys. Rows whose own reference fails are direct orphans. A row whose reference
holds, but whose target rows are all orphans themselves, inherits the fault. The cascade runs down the graph to its
fixpoint: a table's orphans are written out, its rows are joined with them, and a key without a sound row left is marked
in the lifetimes that the children's references are judged by, in one join a table. An acyclic graph reaches the fixpoint
in one pass from the parents to the children; a cyclic one iterates until a round finds nothing new.

Lifetimes, one row a key, are written out too. They are broadcast only if their counted rows allow; otherwise both sides
of the join are shuffled by the key and sorted, with nothing between, so that adaptive execution splits a partition that
one hot key fills.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import checkpointed, col

MISSING, LATER, DELETED, INHERITED = "missing", "later", "deleted", "inherited"
#: Rows of a written join side that may be broadcast; a row holds a key and a few fixed columns.
BROADCAST_ROWS = 10_000


def _written(df: DataFrame) -> DataFrame:
    """df checkpointed, with a broadcast hint if its rows, now counted, are few."""
    rows = checkpointed(df)
    return F.broadcast(rows) if rows.count() <= BROADCAST_ROWS else rows


@dataclass(frozen=True)
class Entity:
    """A table of the graph: begin and end bound the time in which its key may be referred to."""

    name: str
    df: DataFrame
    row_id: str | None = None
    time: str | None = None
    key: str | None = None
    begin: str | None = None
    end: str | None = None


@dataclass(frozen=True)
class ForeignKey:
    child: str
    field: str
    parent: str


@dataclass(frozen=True)
class ReferenceGraph:
    """Entities by name and the references between them."""

    entities: dict[str, Entity]
    keys: Sequence[ForeignKey] = field(default_factory=tuple)

    @staticmethod
    def of(entities: Sequence[Entity], keys: Sequence[ForeignKey]) -> "ReferenceGraph":
        return ReferenceGraph({e.name: e for e in entities}, tuple(keys))

    def lifetimes(self, name: str, orphans: DataFrame | None = None) -> DataFrame:
        """One row per key of the entity: its first begin, its last end or null if any row has none, and whether all its
        rows are among the orphans. Written to the checkpoint folder."""
        e = self.entities[name]
        rows = e.df.where(col(e.key).isNotNull()).select(
            col(e.key).alias("_key"),
            (col(e.begin) if e.begin else F.lit(None).cast("timestamp_ntz")).alias("_b"),
            (col(e.end) if e.end else F.lit(None).cast("timestamp_ntz")).alias("_e"),
            (col(e.row_id).cast("bigint") if e.row_id else F.lit(None).cast("bigint")).alias("_id"),
        )
        heir = F.lit(False)
        if orphans is not None:
            bad = _written(orphans.where(F.col("src_table") == name).select(F.col("row_id").alias("_bad")).distinct())
            rows = rows.join(bad, F.col("_id") == F.col("_bad"), "left")
            heir = F.count(F.lit(1)) == F.count("_bad")
        return _written(rows.groupBy("_key").agg(
            F.min("_b").alias("_begin"), F.when(F.count("_e") == F.count(F.lit(1)), F.max("_e")).alias("_end"), heir.alias("_heir"), F.lit(True).alias("_there")
        ))

    def references(self, child: str, parent: str) -> DataFrame:
        """The non-null references of child to parent, one row per row and field; the table is read once."""
        e = self.entities[child]
        fields = [k.field for k in self.keys if (k.child, k.parent) == (child, parent)]
        pairs = F.array(*(F.struct(F.lit(f).alias("field"), col(f).alias("ref")) for f in fields))
        return (
            e.df.select(col(e.row_id).alias("_row_id"), col(e.time).alias("_time"), F.explode(pairs).alias("_p"))
            .select("_row_id", "_time", F.col("_p.field").alias("_field"), F.col("_p.ref").alias("_ref"))
            .where(F.col("_ref").isNotNull())
        )

    def judged(self, child: str, parent: str, orphans: DataFrame | None = None) -> DataFrame:
        """The orphans of child that refer to parent, given the parent's own. Without a time only `missing` can be judged."""
        refs, life = self.references(child, parent), self.lifetimes(parent, orphans)
        t = F.col("_time")
        reason = F.when(F.col("_there").isNull(), MISSING).when(F.col("_begin") > t, LATER).when(F.col("_end") <= t, DELETED).when(F.col("_heir"), INHERITED)
        rows = refs.join(life, refs["_ref"] == life["_key"], "left").select("_row_id", "_time", "_field", "_ref", reason.alias("_reason")).where("_reason IS NOT NULL")
        # rows without an id are told apart by what they say; of repeated ids the first reason in order of precedence
        alone = F.when(F.col("_row_id").isNull(), F.struct("_ref", "_time"))
        order = F.array_position(F.array(*map(F.lit, (MISSING, LATER, DELETED, INHERITED))), F.col("_reason"))
        once = rows.groupBy("_field", "_row_id", alone.alias("_alone")).agg(F.min(F.struct(order.alias("o"), F.col("_time").alias("t"), F.col("_reason").alias("r"))).alias("x"))
        return once.select(
            F.lit(child).alias("src_table"),
            F.col("_field").alias("field"),
            F.col("_row_id").cast("bigint").alias("row_id"),
            F.date_format("x.t", "yyyy-MM").alias("period"),
            F.col("x.r").alias("reason"),
            F.when(F.col("x.r") == INHERITED, INHERITED).otherwise("direct").alias("kind"),
        )

    def _parents_first(self) -> list[str] | None:
        """The entities in an order in which each parent precedes its children; None if the graph has a cycle."""
        left, order = set(self.entities), []
        while left:
            free = sorted(n for n in left if not any(k.child == n and k.parent in left for k in self.keys))
            if not free:
                return None
            order += free
            left -= set(free)
        return order

    def orphans(self, max_rounds: int = 100) -> DataFrame:
        """All orphans: (src_table, field, row_id, period, reason, kind), one row per row and field.

        period is the month of the referring row's time, null without one. reason is missing, later or deleted for
        direct orphans, in this order of precedence, and inherited otherwise. Null is no reference, the empty text is
        one. Repeated rows count once; where rows of one id disagree, the first reason and its earliest time count. Rows
        without an id are one for each reference and time. Tables may be empty and may have further columns of any name.
        """
        pairs = list(dict.fromkeys((k.child, k.parent) for k in self.keys))
        order = self._parents_first()
        if order is not None:
            found: dict[str, DataFrame] = {}
            for name in order:
                own = [self.judged(name, parent, found.get(parent)) for child, parent in pairs if child == name]
                if own:
                    rows = reduce(DataFrame.unionByName, own)
                    # what children refer to is written once, so the plan of a table doesn't hold those above it
                    found[name] = checkpointed(rows) if any(parent == name for _, parent in pairs) else rows
            return reduce(DataFrame.unionByName, found.values())
        known, n = None, -1
        for _ in range(max_rounds):
            known = checkpointed(reduce(DataFrame.unionByName, (self.judged(c, p, known) for c, p in pairs)))
            before, n = n, known.count()
            if n == before:
                return known
        raise RuntimeError("the cascade didn't end")

    def report(self) -> DataFrame:
        """Orphans counted by table, field, period, kind and reason."""
        return self.orphans().groupBy("src_table", "field", "period", "kind", "reason").agg(F.count(F.lit(1)).alias("n"))
