"""Independent SQL for the registered queries, written in the direct, unoptimised form."""

from oracles import clusters, marts, order, quality, sources, statistics

ORACLES: dict[str, str] = {**marts.SQL, **clusters.SQL, **order.SQL, **statistics.SQL, **quality.SQL, **sources.SQL}
