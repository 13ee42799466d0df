"""Results as text: a summary, notes and a block of tab-separated lines. For the driver, at most 2,000 rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabweave.errors import EngineError
from tabweave.functions.model import fmt
from tabweave.operators import aggregate, joins, predicates
from tabweave.plans.query import Result, measured


def escaped(value: object) -> str:
    text = value.strftime("%Y-%m-%d") if hasattr(value, "strftime") else fmt(value) if not isinstance(value, str) else value
    return text.replace("\t", "␉").replace("\r\n", "⏎").replace("\n", "⏎").replace("\r", "⏎")


def _facts(result: Result) -> tuple[int, int, list[str]]:
    """Scanned rows, matched rows and notes on cells that sums and averages leave out: one job."""
    hit = predicates.all_of([predicates.condition(result.source.find(w.col), w.op, w.value) for w in result.query.where])
    summed = [m for m in result.query.measures if m.fn in ("sum", "avg")]
    left_out = [aggregate.skipped(result.matched.find(m.col)).alias(f"s{i}") for i, m in enumerate(summed)]
    found = result.matched.df.agg(F.count("*").alias("n"), *left_out).first() if hit is not None else result.source.df.agg(F.count("*").alias("n"), *left_out).first()
    scanned = result.source.df.count() if hit is not None else found["n"]
    return scanned, found["n"], [f"{found[f's{i}']} cells of {m.col} are no numbers and left out" for i, m in enumerate(summed) if found[f"s{i}"]]


def _told(result: Result, checked: bool) -> tuple[list, int, int, int, list[str]]:
    """Rows (one more than is shown, if there are more), how many there are, scanned and matched rows, and notes on cells left out."""
    limit = result.query.limit
    if result.kind == "aggregate":  # one job tells all
        run = measured(result)
        rows = run.df.collect()
        scanned, found, total = run.scanned.get["n"], run.matched.get, run.groups.get["n"]
        if checked and total > aggregate.GROUP_LIMIT:
            raise EngineError("TOO_MANY_GROUPS", f"more than {aggregate.GROUP_LIMIT} groups; filter first, or group by another column")
        if checked and result.query.joins and scanned > joins.ROWS_LIMIT:
            raise EngineError("TOO_MANY_ROWS", f"the join makes more than {joins.ROWS_LIMIT} rows")
        summed = [m for m in result.query.measures if m.fn in ("sum", "avg")]
        return rows, total, scanned, found["n"], [f"{found[f's{i}']} cells of {m.col} are no numbers and left out" for i, m in enumerate(summed) if found[f"s{i}"]]
    rows = result.df.collect() if result.full is None else result.full.limit(limit + 1).collect()
    return rows, result.full.count() if result.full is not None and len(rows) > limit else len(rows), *_facts(result)


def rendered(result: Result, checked: bool = False) -> dict:
    """text and meta: kind, columns, shown and total rows, scanned and matched rows, truncation. checked: limits on groups and joined rows are enforced by what the same job counts."""
    limit = result.query.limit
    rows, total, scanned, matched, notes = _told(result, checked)
    if not scanned and result.kind == "profile":
        return {"text": f"{result.source.name}: no rows", "meta": {"kind": "empty", "scannedRows": 0, "matchedRows": 0}}
    truncated = result.full is not None and len(rows) > limit
    rows = rows[:limit] if truncated else rows
    if truncated:
        notes.append(f"the first {limit} of {total} rows are shown")
    if result.kind == "profile" and (blank := [r["column"] for r in rows if not r["non_null"]]):
        notes.append(f"blank columns: {', '.join(blank)}")
    notes += [f"{j.type} join with {j.path or 'itself'} on {', '.join(f'{a} = {b}' if a != b else a for a, b in j.keys)}" for j in result.query.joins]
    notes += [*result.notes, *result.source.notes] + (["the source was cut at its limits"] if result.source.truncated else [])
    lines = ["\t".join(map(escaped, result.columns)), *("\t".join(escaped(v) for v in r) for r in rows)]
    head = f"{result.source.name}: {scanned} rows x {len(result.source.names)} columns" + ("" if matched == scanned else f" -> {matched} matched")
    text = "\n".join([head, *(f"> {n}" for n in dict.fromkeys(notes)), "```tsv", *lines, "```"])
    return {"text": text, "meta": {"kind": result.kind, "columns": result.columns, "shown": len(rows), "total": total, "scannedRows": scanned, "matchedRows": matched, "truncated": truncated}}
