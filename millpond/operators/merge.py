"""Keyed upserts on DataFrames: MERGE, UPDATE, DELETE and insert-if-unseen.

Clause conditions and values are SQL text over two names, ``t`` (target row) and
``s`` (source row): ``update({"sales": "s.sales"}, when="s.kind = 'new'")``.

Source keys are counted once by a hash aggregate, a small job of its own; what it finds decides the plan:

* no key repeats and the target is small (or the part of a table that a batch touches): one full
  outer join;
* no key repeats and the target is large: the target is *left* joined to the source, which Spark
  can turn into a broadcast join (a full outer join cannot broadcast and always shuffles the whole
  target), and new rows come from an anti join against only those target keys that occur in the
  source;
* some keys repeat: clauses are evaluated on every pair, and the target rows of those keys alone
  are brought back to one row each. A target row that two source rows would change raises; source
  rows that no clause would use do not count.

Rows with a null key can match nothing, so they skip the joins altogether. ``staged=True`` writes
a source that is expensive to compute once, before it is counted and joined.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millpond.operators.keys import assign
from millpond.session import materialise

#: Bytes by the planner's estimate up to which a target meets its source in one full outer join.
SMALL_TARGET = 256 << 20
_TARGET_REF = re.compile(r"(?<![\w.`])t\.")


@dataclass(frozen=True)
class Clause:
    """One WHEN branch; ``values=None`` takes every column by name."""

    action: str
    values: Mapping[str, str] | None = None
    when: str | None = None

    def condition(self) -> Column:
        return F.coalesce(F.expr(self.when), F.lit(False)) if self.when else F.lit(True)


def update(values: Mapping[str, str], when: str | None = None) -> Clause:
    return Clause("update", dict(values), when)


def update_all(when: str | None = None) -> Clause:
    return Clause("update", None, when)


def delete(when: str | None = None) -> Clause:
    return Clause("delete", {}, when)


def insert(values: Mapping[str, str], when: str | None = None) -> Clause:
    return Clause("insert", dict(values), when)


def insert_all(when: str | None = None) -> Clause:
    return Clause("insert", None, when)


def merge(
    target: DataFrame,
    source: DataFrame,
    on: Sequence[str] | Mapping[str, str],
    matched: Sequence[Clause] = (),
    not_matched: Sequence[Clause] = (),
    match_target: str | None = None,
    match_source: str | None = None,
    identity: str | None = None,
    staged: bool = False,
    identity_after: int | None = None,
) -> DataFrame:
    """The target after the merge.

    ``on`` lists the equal keys (or maps target name to source name).
    ``match_target`` / ``match_source`` are further one-sided match conditions.
    The first clause whose condition holds wins; a matched row with none stays.
    Two source rows that would change one target row raise an error. New rows
    get the next numbers in the ``identity`` column, in key order: after ``identity_after``
    where that is given, else after the target's largest.
    """
    source = materialise(source, "merge-source") if staged else source
    plan = _Plan(target, source, on, matched, not_matched, match_target, match_source)
    if matched and not_matched and identity is None and plan.fits_one_join():
        return plan.whole()
    parts = [plan.kept()] if matched else [target]
    if not_matched:
        parts.append(plan.numbered(identity, after=identity_after))
    return reduce(DataFrame.unionByName, parts)


def merge_changes(
    target: DataFrame,
    source: DataFrame,
    on: Sequence[str] | Mapping[str, str],
    matched: Sequence[Clause] = (),
    not_matched: Sequence[Clause] = (),
    match_target: str | None = None,
    match_source: str | None = None,
    identity: str | None = None,
    staged: bool = False,
    numbered_after: DataFrame | None = None,
) -> DataFrame:
    """Only the change rows the same merge would produce, with ``_change_type``.

    Reads the touched target rows alone, so the cost follows the source. An
    update that leaves every column as it was gives no change row. New numbers
    follow the largest in ``numbered_after`` where ``target`` is only a part of
    its table.
    """
    source = materialise(source, "merge-source") if staged else source
    plan = _Plan(target, source, on, matched, not_matched, match_target, match_source)
    parts = []
    if matched:
        parts.append(plan.touched())
    if not_matched:
        parts.append(plan.numbered(identity, numbered_after).withColumn("_change_type", F.lit("insert")))
    return reduce(DataFrame.unionByName, parts)


class _Plan:
    """The pieces that merge and merge_changes are put together from."""

    def __init__(self, target, source, on, matched, not_matched, match_target, match_source):
        self.pairs = dict(on) if isinstance(on, Mapping) else {k: k for k in on}
        self.target, self.source = target, source
        self.matched, self.not_matched = tuple(matched), tuple(not_matched)
        self.match_target = F.expr(match_target) if match_target else F.lit(True)
        self.match_source = F.expr(match_source) if match_source else F.lit(True)
        self._many: DataFrame | None = None
        self._counted = False
        if any(c.action == "insert" for c in self.matched):
            raise ValueError("insert is a not-matched action")
        if any(c.action != "insert" for c in self.not_matched):
            raise ValueError("only insert may follow not matched")

    # -- source side -------------------------------------------------------
    def _wrapped(self) -> DataFrame:
        """Source rows as one struct ``s`` beside key columns ``_k0, _k1, …``."""
        keys = [F.col(f"`{s}`").alias(f"_k{i}") for i, s in enumerate(self.pairs.values())]
        return self.source.select(F.struct("*").alias("s"), *keys)

    def _key_names(self) -> list[str]:
        return [f"_k{i}" for i in range(len(self.pairs))]

    def _can_match(self) -> Column:
        has_keys = reduce(Column.__and__, [F.col(k).isNotNull() for k in self._key_names()])
        return has_keys & F.coalesce(self.match_source, F.lit(False))

    def _usable(self) -> DataFrame:
        """Source rows that may match; where no condition reads the target, only those a clause would use."""
        rows = self._wrapped().filter(self._can_match())
        conditions = [c.when for c in self.matched]
        if all(c is not None and not _TARGET_REF.search(c) for c in conditions):
            rows = rows.filter(reduce(Column.__or__, [c.condition() for c in self.matched]))
        return rows

    def _repeated(self) -> DataFrame | None:
        """The keys that several usable source rows have; None without any. Counted once."""
        if not self._counted:
            found = self._usable().groupBy(*self._key_names()).count().filter("count > 1").drop("count")
            found = materialise(found, "repeated-keys")
            self._many, self._counted = (None if found.isEmpty() else found), True
        return self._many

    def fits_one_join(self) -> bool:
        size = int(str(self.target._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
        return size <= SMALL_TARGET and self._repeated() is None

    # -- target side -------------------------------------------------------
    def _match_on(self) -> Column:
        equal = [F.col(f"t.`{t}`") == F.col(f"_k{i}") for i, t in enumerate(self.pairs)]
        return reduce(Column.__and__, equal) & F.coalesce(self.match_target, F.lit(False))

    def _chosen(self, clauses: Sequence[Clause]) -> Column:
        """Number of the first clause whose condition holds."""
        act = F.when(F.lit(False), F.lit(None).cast("int"))
        for i, clause in enumerate(clauses):
            act = act.when(clause.condition(), F.lit(i))
        return act

    def _acted(self, how: str) -> DataFrame:
        """Target rows with their source row and the chosen clause in ``_act``, one row per target row."""
        many = self._repeated()
        target = self.target if many is None else self.target.withColumn("_row", F.monotonically_increasing_id())
        joined = target.alias("t").join(self._usable(), self._match_on(), how)
        joined = joined.withColumn("_act", F.when(F.col("s").isNotNull(), self._chosen(self.matched)))
        if many is None:
            return joined
        keys = self._key_names()
        names = self.target.columns
        flagged = joined.join(many.select(*[F.col(k).alias(f"_m{k}") for k in keys], F.lit(True).alias("_several")),
                              reduce(Column.__and__, [F.col(k) == F.col(f"_m{k}") for k in keys]), "left")
        packed = flagged.select(F.struct(*[F.col(f"t.`{c}`") for c in names]).alias("t"), "s", "_act", "_row", "_several")
        once = packed.filter("_several IS NULL").select("t", "s", "_act")
        # the pairs of a repeated key: at most one of a target row's may change it, and is the one kept
        best = F.min_by(F.struct("t", "s", "_act"), F.coalesce(F.when(F.col("_act").isNotNull(), 0), F.lit(1)))
        pairs = packed.filter("_several").groupBy("_row").agg(F.count("_act").alias("_n"), best.alias("_p"))
        key = F.concat_ws(", ", *[F.col(f"_p.t.`{t}`").cast("string") for t in self.pairs])
        clash = F.raise_error(F.concat(F.lit("merge: several source rows would change one target row: "), key))
        act = F.when(F.col("_n") > 1, clash).otherwise(F.col("_p._act")).cast("int")
        return once.unionByName(pairs.select("_p.t", "_p.s", act.alias("_act")))

    def whole(self) -> DataFrame:
        """Kept, changed and new rows from one full outer join; source keys do not repeat."""
        marked = self.target.withColumn("_there", F.lit(True)).alias("t")
        rows = self._wrapped().withColumn("_able", self._can_match())
        joined = marked.join(rows.filter("_able"), self._match_on(), "full_outer")
        there = F.col("_there").isNotNull()
        act = F.when(there, F.when(F.col("s").isNotNull(), self._chosen(self.matched))).otherwise(self._chosen(self.not_matched))
        acted = joined.withColumn("_act", act).filter(F.when(there, ~self._deleted()).otherwise(F.col("_act").isNotNull()))
        merged = acted.select([F.when(there, self._new_value(c)).otherwise(self._inserted_value(c)).alias(c) for c in self.target.columns])
        return merged.unionByName(self._fresh(rows.filter("NOT _able")))

    def _new_value(self, name: str) -> Column:
        old = F.col(f"t.`{name}`")
        value = F.when(F.col("_act").isNull(), old)
        for i, clause in enumerate(self.matched):
            given = self._given(clause, name)
            if given is not None:
                value = value.when(F.col("_act") == i, given)
        return value.otherwise(old).cast(self.target.schema[name].dataType).alias(name)

    def _given(self, clause: Clause, name: str) -> Column | None:
        if clause.values is None:
            return F.col(f"s.`{name}`") if name in self.source.columns else None
        return F.expr(clause.values[name]) if name in clause.values else None

    def _deleted(self) -> Column:
        dead = [i for i, c in enumerate(self.matched) if c.action == "delete"]
        return F.coalesce(F.col("_act").isin(dead), F.lit(False)) if dead else F.lit(False)

    def kept(self) -> DataFrame:
        rows = self._acted("left").filter(~self._deleted())
        return rows.select([self._new_value(c) for c in self.target.columns])

    def touched(self) -> DataFrame:
        names = self.target.columns
        before = F.struct(*[F.col(f"t.`{c}`").alias(c) for c in names])
        after = F.struct(*[self._new_value(c) for c in names])
        rows = self._acted("inner").filter(F.col("_act").isNotNull())
        rows = rows.select(before.alias("b"), after.alias("a"), self._deleted().alias("gone"))
        same = reduce(Column.__and__, [F.col(f"b.`{c}`").eqNullSafe(F.col(f"a.`{c}`")) for c in names])
        rows = rows.filter(F.col("gone") | ~same)
        typed = lambda kind, row: F.struct(F.lit(kind).alias("_change_type"), F.col(row).alias("r"))
        events = F.when(F.col("gone"), F.array(typed("delete", "b"))).otherwise(
            F.array(typed("update_preimage", "b"), typed("update_postimage", "a"))
        )
        return rows.select(F.explode(events).alias("e")).select("e.r.*", "e._change_type")

    # -- new rows ----------------------------------------------------------
    def inserted(self) -> DataFrame:
        keys = self._key_names()
        rows = self._wrapped()
        able = rows.filter(self._can_match())
        target_keys = (
            self.target.alias("t")
            .filter(F.coalesce(self.match_target, F.lit(False)))
            .select([F.col(f"t.`{t}`").alias(f"_k{i}") for i, t in enumerate(self.pairs)])
        )
        seen = target_keys.join(able.select(keys), keys, "left_semi").distinct()
        return self._fresh(able.join(seen, keys, "left_anti").unionByName(rows.filter(~self._can_match())))

    def _fresh(self, rows: DataFrame) -> DataFrame:
        acted = rows.withColumn("_act", self._chosen(self.not_matched)).filter(F.col("_act").isNotNull())
        return acted.select([self._inserted_value(c) for c in self.target.columns])

    def numbered(self, identity: str | None, existing: DataFrame | None = None, after: int | None = None) -> DataFrame:
        rows = self.inserted()
        if identity is None:
            return rows
        existing = self.target if existing is None else existing
        return assign(rows.drop(identity), existing, identity, list(self.pairs), after).select(*rows.columns)

    def _inserted_value(self, name: str) -> Column:
        value = F.when(F.lit(False), F.lit(None))
        for i, clause in enumerate(self.not_matched):
            given = self._given(clause, name)
            if given is not None:
                value = value.when(F.col("_act") == i, given)
        return value.cast(self.target.schema[name].dataType).alias(name)


def update_where(df: DataFrame, condition: str, values: Mapping[str, str]) -> DataFrame:
    """UPDATE … SET … WHERE; rows where the condition is false or null stay."""
    hit = F.coalesce(F.expr(condition), F.lit(False))
    return df.select(
        [
            F.when(hit, F.expr(values[c])).otherwise(F.col(c)).cast(df.schema[c].dataType).alias(c)
            if c in values
            else F.col(c)
            for c in df.columns
        ]
    )


def update_in(df: DataFrame, members: DataFrame, on: Sequence[str], values: Mapping[str, str]) -> DataFrame:
    """UPDATE … WHERE (on) IN (members): one equi-join, no row multiplies."""
    return merge(df, members.select(*on).distinct(), on, matched=[update(values)])


def delete_where(df: DataFrame, condition: str) -> DataFrame:
    """DELETE … WHERE; a null condition keeps the row."""
    return df.filter(~F.coalesce(F.expr(condition), F.lit(False)))


def not_in(df: DataFrame, column: str, members: DataFrame) -> DataFrame:
    """``column NOT IN (members)`` with SQL's null rules and without a forced broadcast.

    Spark's own null-aware anti join always broadcasts the subquery. Here the
    null rules are one aggregate over the subquery and the rest is a plain anti
    join, which shuffles when the subquery is large.
    """
    values = members.select(F.col(members.columns[0]).alias("_m"))
    n, known = F.count("*"), F.count("_m")
    kind = F.when(n == 0, "empty").when(n == known, "known").otherwise("has null")
    kind = values.agg(kind.alias("kind")).scalar()
    rest = df.join(values, F.col(column) == F.col("_m"), "left_anti")
    return rest.filter((kind == "empty") | ((kind == "known") & F.col(column).isNotNull()))
