"""The warehouse as named relations, each a function of others, built once a run."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from ..operators import identity, measures, pairs, staging, star

Node = tuple[tuple[str, ...], Callable[..., DataFrame]]

WAREHOUSE: dict[str, Node] = {
    "stg_demo": (("demo",), staging.stage_demo),
    "stg_drug": (("drug",), staging.stage_drug),
    "stg_reac": (("reac",), staging.stage_reac),
    "stg_outc": (("outc",), staging.stage_outc),
    "lookup": (("stg_drug",), identity.name_lookup),
    "resolved": (("stg_drug", "lookup"), identity.resolve),
    "strings": (("resolved",), identity.strings),
    "pieces": (("strings",), identity.piece_totals),
    "piece_identity": (("pieces", "seed", "rxcui", "related"), identity.piece_identity),
    "string_identity": (("strings", "piece_identity"), identity.string_identity),
    "demographics": (("stg_demo",), pairs.demographics),
    "pairs": (("resolved", "string_identity", "stg_reac", "demographics"), pairs.case_pairs),
    "contingency": (("pairs",), pairs.contingency),
    "pair_quarters": (("pairs",), pairs.pair_quarters),
    "prr": (("contingency",), measures.prr),
    "ror": (("contingency",), measures.ror),
    "signals": (("contingency", "pair_quarters"), measures.signals),
    "dim_drug": (("string_identity", "signals"), star.dim_drug),
    "dim_reaction": (("pairs",), star.dim_reaction),
    "dim_outcome": (("stg_outc",), star.dim_outcome),
    "dim_demographics": (("demographics",), star.dim_demographics),
    "fact": (("pairs", "demographics", "stg_outc"), star.fact),
}

#: Relations that several others read and that cost more to build than to write.
WRITTEN = ("stg_drug", "resolved", "strings", "piece_identity", "string_identity", "pairs", "contingency", "pair_quarters", "signals")


class Warehouse:
    """Relations by name over the given sources; ``materialise`` writes a relation that several others read, once."""

    def __init__(self, sources: dict[str, DataFrame], materialise: Callable[[str, DataFrame], DataFrame] | None = None):
        self.built = dict(sources)
        self.materialise = materialise

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self.built:
            deps, make = WAREHOUSE[name]
            df = make(*(self[d] for d in deps))
            if self.materialise and name in WRITTEN:
                df = self.materialise(name, df)
            self.built[name] = df
        return self.built[name]


def order(wanted: str) -> list[str]:
    """The relations that ``wanted`` needs, dependencies first."""
    out: list[str] = []

    def visit(name: str) -> None:
        if name in WAREHOUSE and name not in out:
            for d in WAREHOUSE[name][0]:
                visit(d)
            out.append(name)

    visit(wanted)
    return out
