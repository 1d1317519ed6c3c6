"""Orchestration: which sources changed, selective silver rebuild, gold in dependency order, check-repair-rebuild-check."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from lumbung.functions import keys
from lumbung.plans import gold, silver
from lumbung.sources.store import Files, Store

GRANT_KINDS = ("penelitian", "pengabdian", "buku_keilmuan")
PREFIXES = {"penelitian": "PN", "pengabdian": "PB", "buku_keilmuan": "BK", "sitasi": "ST"}
Manifest = dict[str, dict]


def load_manifest(files: Files, path: str) -> Manifest:
    """The manifest of the last successful run; empty if there is none."""
    return json.loads(files.read(path)) if files.exists(path) else {}


def write_manifest(files: Files, path: str, manifest: Manifest) -> None:
    """To be called after success only."""
    files.create(path, json.dumps(manifest, sort_keys=True).encode(), overwrite=True)


def etags(files: Files, folder: str, categories: dict[str, str]) -> dict[str, str]:
    """Tag (length and time of change) of each source file that is there; missing files are skipped."""
    there = {s["name"]: f"{s['length']}-{s['modified']}" for s in files.list(folder)}
    return {name: there[name] for name in categories if name in there}


def compare(old: Manifest, tags: dict[str, str], categories: dict[str, str], now: datetime | None = None) -> tuple[Manifest, list[str]]:
    """New manifest and changed categories: files that are new or whose tag changed. Files no longer seen drop out silently."""
    checked = (now or datetime.now(timezone.utc)).isoformat()
    new = {
        name: {"etag": tag, "last_checked": checked, "category": categories[name], "changed": old.get(name, {}).get("etag") != tag}
        for name, tag in tags.items()
    }
    return new, sorted({m["category"] for m in new.values() if m["changed"]})


_STATEMENT = re.compile(r"""--[^\n]*|/\*.*?\*/|'(?:[^'\\]|\\.|'')*'|"(?:[^"\\]|\\.)*"|`[^`]*`|;|[^;'"`/-]+|[/-]""", re.S)


def statements(script: str) -> list[str]:
    """Statements of a SQL script; semicolons in texts, names and comments do not end one. Comments are left out."""
    out = [""]
    for piece in _STATEMENT.findall(script):
        if piece == ";":
            out.append("")
        elif not piece.startswith(("--", "/*")):
            out[-1] += piece
    return [s.strip() for s in out if s.strip()]


def run_script(spark: SparkSession, script: str) -> DataFrame | None:
    """Run a SQL script statement by statement; the result of the last one, None for an empty script."""
    result = None
    for statement in statements(script):
        result = spark.sql(statement)
    return result


def build_bronze(store: Store, category: str, sheets: Iterable[DataFrame]) -> None:
    from functools import reduce

    store.table(f"bronze.{category}").create_or_replace(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), sheets))


def build_silver(store: Store, category: str, bronze: DataFrame | None = None) -> None:
    """From the given bronze frame (as cached by the ingest) or else from the bronze table."""
    rows = bronze if bronze is not None else store.table(f"bronze.{category}").read()
    made = silver.citations(rows, PREFIXES[category]) if category == "sitasi" else silver.grants(rows, PREFIXES[category], category)
    store.table(f"silver.{category}").create_or_replace(made)


def _grants(store: Store) -> DataFrame:
    from functools import reduce

    there = [store.table(f"silver.{k}") for k in GRANT_KINDS]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [t.read() for t in there if t.exists()])


def build_people(store: Store) -> None:
    store.table("gold.dim_dosen").create_or_replace(gold.dim_person(_grants(store)))


def build_dependents(store: Store) -> None:
    """Everything that depends on silver and on the persons, in order."""
    grants, people = _grants(store), store.table("gold.dim_dosen").read()
    scheme, theme = store.table("gold.dim_skema").read(), store.table("gold.dim_sdgs").read()
    store.table("gold.dim_hibah_proposal").create_or_replace(gold.dim_proposal(grants))
    store.table("gold.fact_hibah").create_or_replace(gold.fact_grant(grants, people, scheme, theme), [("tahun", "identity")])
    store.table("gold.fact_dosen_hibah").create_or_replace(gold.fact_person_grant(grants, people), [("tahun", "identity")])
    if store.table("silver.sitasi").exists():
        citations = store.table("silver.sitasi").read()
        store.table("gold.dim_jurnal").create_or_replace(gold.dim_journal(citations))
        store.table("gold.fact_sitasi").create_or_replace(gold.fact_citation(citations, people, store.table("gold.dim_jurnal").read(), keys.int_key))


def run(store: Store, changed: Iterable[str], bronze: dict[str, DataFrame] | None = None) -> None:
    """Silver of the changed categories only, then the whole gold layer."""
    for category in changed:
        build_silver(store, category, (bronze or {}).get(category))
    build_people(store)
    build_dependents(store)


def check_repair_check(store: Store, checks: Callable[[Store], DataFrame], repairs: list[Callable[[Store], object]], report: str = "dq.dq_report") -> tuple[int, int]:
    """Failures before and after: check, every repair in turn, rebuild, check again. A blocked repair stops the chain."""
    failures = []
    for last in (False, True):
        if last:
            for repair in repairs:
                repair(store)
            build_people(store)
            build_dependents(store)
        rows = checks(store)
        table = store.table(report)
        (table.append if table.exists() else table.create_or_replace)(rows)
        newest = table.read().orderBy("run_timestamp", ascending=False).first()["run_id"]
        failures.append(table.read().where(f"run_id = '{newest}' AND status = 'FAIL'").count())
    return failures[0], failures[1]


