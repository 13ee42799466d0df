"""A query's filters and grouping over a stream, by event-time windows with a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabweave.errors import EngineError
from tabweave.operators import aggregate, predicates
from tabweave.plans.spec import Query
from tabweave.plans.table import Table


def windowed(stream: DataFrame, spec: dict, time: str, window: str = "5 minutes", slide: str | None = None, late: str = "10 minutes") -> DataFrame:
    """where, groupBy and aggregate of a specification over windows of `time`. countDistinct is approximate here, and there is no order."""
    query = Query.from_json(spec)
    if query.mode != "aggregate" or query.joins:
        raise EngineError("INVALID_ARGS", "a stream takes where, groupBy and aggregate")
    table = Table.of(stream.withWatermark(time, late))
    rows = table.where(predicates.all_of([predicates.condition(table.find(c.col), c.op, c.value) for c in query.where]))
    keys = [k.alias(f"{name}" if j == 0 else f"{name}_{j}") for name in query.group_by for j, k in enumerate(rows.find(name).keys())]
    measures = [aggregate.aggregate(rows.find(m.col), m.fn, approximate=True).alias(aggregate.measure_name(rows, m)) for m in query.measures] or [F.count("*").alias("rows")]
    at = f"c{rows.index(time)}"
    return rows.df.groupBy(F.window(at, window, slide) if slide else F.window(at, window), *keys).agg(*measures)
