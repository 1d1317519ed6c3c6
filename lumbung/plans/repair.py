"""Repairs on a branch of a versioned table, published only when every gate holds."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumbung.functions import names
from lumbung.functions.keys import int_key
from lumbung.plans import quality
from lumbung.sources.store import MAIN, Store

AUDIT = "audit"
Counts = dict[str, int]


class Blocked(RuntimeError):
    """A gate did not hold; the branch is kept for inspection."""


def purge_blank(rows: DataFrame, column: str) -> DataFrame:
    return rows.where(~quality.blank(F.col(column)))


def unswap(rows: DataFrame, swap: quality.Swap) -> DataFrame:
    """Values that belong to the other column change places.

    Both wrong: exchanged. One column null and the other holding its value: it moves. All else stays. Rows are kept; a second
    run changes nothing.
    """
    r = quality.placed(rows, swap)
    a, b = F.col(swap.a), F.col(swap.b)
    aa, ab, bb, ba = (F.col(c) for c in ("__aa", "__ab", "__bb", "__ba"))
    both, to_a, to_b = ab & ba & ~aa & ~bb, a.isNull() & ba, b.isNull() & ab
    new_a = F.when(both | to_a, b).when(to_b, None).otherwise(a)
    new_b = F.when(both | to_b, a).when(to_a, None).otherwise(b)
    return r.withColumns({swap.a: new_a, swap.b: new_b}).select(*rows.columns)


@dataclass(frozen=True)
class Gate:
    name: str
    holds: Callable[[Counts, Counts], bool]  # counts before and after


def zero(count: str) -> Gate:
    return Gate(f"{count} = 0", lambda before, after: after[count] == 0)


def none_of(name: str, *counts: str) -> Gate:
    return Gate(f"{name} = 0", lambda before, after: sum(after[c] for c in counts) == 0)


def not_more(name: str, *counts: str) -> Gate:
    return Gate(f"{name} not more", lambda before, after: sum(after[c] for c in counts) <= sum(before[c] for c in counts))


def conserved(total: str = "total", purged: str | None = None) -> Gate:
    return Gate("rows kept", lambda b, a: a[total] == b[total] - (b[purged] if purged else 0))


SWAP_GATES = (
    none_of("broken", "null_judul", "both_swapped", "a_only", "b_only"),
    zero("null_judul"),
    zero("equal"),
    not_more("invalid", "invalid_a", "invalid_b"),
    conserved(purged="null_judul"),
)
PURGE_GATES = (zero("null_judul"), conserved(purged="null_judul"))


def counts_of(frame: DataFrame) -> Counts:
    return frame.first().asDict()


def audit_and_publish(store: Store, name: str, fix: Callable[[DataFrame], DataFrame], audit: Callable[[DataFrame], DataFrame], gates, branch: str = AUDIT) -> tuple[Counts, Counts]:
    """Write the repaired table to a fresh branch, audit main and branch once each, and fast-forward main if all gates hold."""
    table = store.table(name)
    table.drop_branch(branch, if_exists=True)
    table.create_branch(branch)
    table.overwrite(fix(table.read(branch)), branch=branch)
    before, after = counts_of(audit(table.read(MAIN))), counts_of(audit(table.read(branch)))
    failed = [g.name for g in gates if not g.holds(before, after)]
    if failed:
        raise Blocked(f"{name}: {', '.join(failed)}; before {before}, after {after}")
    table.fast_forward(branch)
    table.drop_branch(branch)
    return before, after


def map_names(
    store: Store, mentions: str, column: str, people: str, name: str, key: str | None = None, branch: str = AUDIT, strict: bool = False, literal: bool = False
) -> tuple[Counts, Counts]:
    """Mentions get the canonical name of their root, persons not known yet are added, and both tables are published in one
    checked step.

    ``key``: the column of the persons' 32-bit key, made from the name; other columns of new persons are null. ``strict`` asks for fewer unmatched names than before; ``literal`` looks for new persons among the names before mapping.
    """
    m, p = store.table(mentions), store.table(people)
    for t in (m, p):
        t.drop_branch(branch, if_exists=True)
        t.create_branch(branch)
    known = p.read(MAIN)
    before = counts_of(quality.name_counts(m.read(MAIN), column, known, name))
    m.overwrite(names.canonicalised(m.read(branch), column, names.longest_by_root(known, name)), branch=branch)
    seen = m.read(MAIN if literal else branch).select(F.col(column).alias(name)).distinct()
    fresh = seen.where(~names.invalid_person(F.col(name))).join(known.select(name), name, "left_anti")
    made = {key: int_key(F.col(name), F.lit(""))} if key else {}
    rest = [made.get(c, F.lit(None)).cast(t).alias(c) for c, t in known.dtypes if c != name]
    p.append(fresh.select(name, *rest).select(*known.columns), branch=branch)
    after = counts_of(quality.name_counts(m.read(branch), column, p.read(branch), name))
    fewer = after["unmatched_valid"] < before["unmatched_valid"] if strict else after["unmatched_valid"] <= before["unmatched_valid"]
    checks = {
        "no unmatched name": after["unmatched_valid"] == 0,
        "unmatched names fewer" if strict else "unmatched names not more": fewer,
        "invalid names kept": after["invalid"] == before["invalid"],
        "empty names kept": after["empty"] == before["empty"],
        "rows kept": after["total"] == before["total"],
    }
    if not all(checks.values()):
        raise Blocked(f"{mentions}: {[k for k, ok in checks.items() if not ok]}; before {before}, after {after}")
    store.publish([(mentions, branch, MAIN), (people, branch, MAIN)])
    for t in (m, p):
        t.drop_branch(branch)
    return before, after
