"""Equi-joins on normalised keys, with coalesced keys of the same name, renamed columns and match statistics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabweave.errors import EngineError
from tabweave.functions.values import Cell, kind_of
from tabweave.plans.spec import Join
from tabweave.plans.table import ROW, Table, resolve

ROWS_LIMIT = 2_000_000


def renamed(left: list[str], right: list[str], dropped: set[int], join: Join) -> dict[int, str]:
    """Names of the right columns that stay: label·name, then suffix, then suffix with a number, until free."""
    used, out = set(left), {}
    for i, name in enumerate(right):
        if i in dropped:
            continue
        base = f"{join.label}·{name}" if join.label else name
        found, n = base, 2
        while found in used:
            found, n = f"{base}{join.suffix}{n if n > 2 else ''}", n + 1
        used.add(found)
        out[i] = found
    return out


def _key(left: Cell, right: Cell) -> tuple[Column, Column]:
    """Native columns if both types settle the same kind; normalised text keys otherwise. Blank keys are null and match nothing."""
    kinds = {left.kind, right.kind}
    if len(kinds) == 1 and kinds <= {"number", "time", "bool"}:
        return left.keys()[0], right.keys()[0]
    if kinds == {"number", "text"}:
        return left.num(), right.num()
    return left.joined_key(), right.joined_key()


def _sides(left: Table, right: Table, join: Join) -> tuple[DataFrame, DataFrame, Column, list[tuple[int, int, bool]]]:
    pairs = []
    for a, b in join.keys:
        i, j = resolve(list(left.names), a, "on the left"), resolve(list(right.names), b, "on the right")
        pairs.append((i, j, left.names[i] == right.names[j]))
    l, r = left.df, right.df.select(*(F.col(f"c{i}").alias(f"r{i}") for i in range(len(right.names))), *([F.col(ROW).alias("right_row")] if right.ordered else []))
    on = []
    for k, (i, j, _) in enumerate(pairs):
        a, b = _key(left.cell(i), Cell(F.col(f"r{j}"), right.df.schema[f"c{j}"].dataType))
        l, r = l.withColumn(f"left_key{k}", a), r.withColumn(f"right_key{k}", b)
        on.append(F.col(f"left_key{k}") == F.col(f"right_key{k}"))
    return l, r, reduce(lambda a, b: a & b, on), pairs


def _matched(l: DataFrame, r: DataFrame, on: Column, kind: str, keys: int) -> DataFrame:
    """The join. In outer joins rows with a blank key, which match nothing, are not exchanged (all to one place) but put beside the result."""
    if kind == "inner":
        return l.join(r, on)
    whole = {side: reduce(lambda a, b: a & b, (F.col(f"{side}_key{k}").isNotNull() for k in range(keys))) for side in ("left", "right")}
    out = l.where(whole["left"]).join(r.where(whole["right"]), on, kind)
    for side, df, kinds in (("left", l, ("left", "full")), ("right", r, ("right", "full"))):
        if kind in kinds:
            out = out.unionByName(df.where(~whole[side]), allowMissingColumns=True)
    return out


def joined(left: Table, right: Table, join: Join, rows_limit: int | None = None) -> Table:
    """rows_limit: raise TOO_MANY_ROWS beyond it (costs a bounded job)."""
    l, r, on, pairs = _sides(left, right, join)
    out = _matched(l, r, on, join.type, len(pairs))
    same = {i: j for i, j, s in pairs if s}
    names = renamed(list(left.names), list(right.names), set(same.values()), join)

    def either(i: int, j: int) -> Column:
        a, b = F.col(f"c{i}"), F.col(f"r{j}")
        if kind_of(left.df.schema[f"c{i}"].dataType) != kind_of(right.df.schema[f"c{j}"].dataType):
            a, b = a.cast("string"), b.cast("string")
        return F.coalesce(a, b)

    columns = [either(i, same[i]).alias(f"c{i}") if i in same and join.type in ("right", "full") else F.col(f"c{i}") for i in range(len(left.names))]
    columns += [F.col(f"r{j}").alias(f"c{len(left.names) + k}") for k, j in enumerate(names)]
    if left.ordered:
        columns.append(F.coalesce(F.col(ROW), F.lit(1 << 40) + (F.col("right_row") if right.ordered else F.lit(0))).alias(ROW))
    result = out.select(*columns)
    if rows_limit and result.limit(rows_limit + 1).count() > rows_limit:
        raise EngineError("TOO_MANY_ROWS", f"the join makes more than {rows_limit} rows")
    return Table(result, (*left.names, *names.values()), left.name, left.truncated or right.truncated, left.header_row, left.notes + right.notes)


def match_statistics(left: Table, right: Table, join: Join) -> DataFrame:
    """One row: matched_left, unmatched_left, unmatched_right (null but for right and full joins)."""
    l, r, on, pairs = _sides(left, right, join)
    keys = [f"right_key{k}" for k in range(len(pairs))]
    seen = l.join(r.select(*keys).distinct().withColumn("hit", F.lit(True)), on, "left").agg(F.count_if("hit").cast("long").alias("matched_left"), F.count_if(F.col("hit").isNull()).cast("long").alias("unmatched_left"))
    if join.type not in ("right", "full"):
        return seen.withColumn("unmatched_right", F.lit(None).cast("long"))
    orphans = r.join(l.select(*(f"left_key{k}" for k in range(len(pairs)))).distinct(), on, "left_anti").agg(F.count("*").alias("unmatched_right"))
    return seen.join(F.broadcast(orphans))  # one row each
