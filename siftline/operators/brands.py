"""Brand tokens and where they occur in domains and page texts."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.strings import squash
from ..functions.urls import bare_domain

#: Brands, and letters of their tokens, that go to every task; a larger catalog is refused.
MOST, LETTERS = 20_000, 4_000_000
#: Rows of a batch whose texts are Python's at a time.
AT_ONCE = 64


def with_tokens(brands: DataFrame, least: int = 3) -> DataFrame:
    """brands with tokens: name, aliases and first labels of official domains, squashed, of at least `least` letters."""
    empty = F.array().cast("array<string>")
    labels = F.transform(F.coalesce("official_domains", empty), lambda d: F.split(bare_domain(d), "[.]")[0])
    every = F.concat(F.array("name"), F.coalesce("aliases", empty), labels)
    return brands.withColumn("tokens", F.array_sort(F.array_distinct(F.filter(F.transform(every, squash), lambda t: F.length(t) >= least))))


@dataclass(frozen=True)
class Catalog:
    """Brands in their order: brand, sector, category and tokens of each. It goes to every task, so its size is checked."""

    rows: tuple[tuple[str | None, str | None, str | None, tuple[str, ...]], ...]

    def __post_init__(self) -> None:
        if len(self.rows) > MOST or sum(len(t) for r in self.rows for t in r[3]) > LETTERS:
            raise ValueError(f"more than {MOST} brands, or {LETTERS} letters of their tokens")


def catalog(brands: DataFrame) -> Catalog:
    rows = with_tokens(brands).orderBy("brand_no").select("name", "sector", "category", "tokens").limit(MOST + 1).collect()
    return Catalog(tuple((r["name"], r["sector"], r["category"], tuple(r["tokens"])) for r in rows))


def automaton(own: Catalog):
    """Finds every token in one pass over a text, whatever their number; a token's value tells its brands."""
    import ahocorasick

    of: dict[str, list[int]] = {}
    for i, (*_, tokens) in enumerate(own.rows):
        for t in tokens:
            of.setdefault(t, []).append(i)
    found = ahocorasick.Automaton()
    for t, brands in of.items():
        found.add_word(t, (t, brands))
    found.make_automaton()
    return found


def evidence(found, own: Catalog, domain: str, text: str) -> list[dict]:
    """The brands with tokens in domain or text (both squashed), in catalog order, and for each token found whether the
    domain contains it, or else the text."""
    told: dict[int, set[str]] = {}
    seen: set[str] = set()
    for where, x in (("domain", domain), ("text", text)):
        for t, brands in {v[0]: v for _, v in found.iter(x)}.values() if x else ():
            if t not in seen:
                seen.add(t)
                for i in brands:
                    told.setdefault(i, set()).add(f"{where} contains brand token '{t}'")
    return [dict(zip(("brand", "sector", "category", "evidence"), (*own.rows[i][:3], sorted(told[i])), strict=True)) for i in sorted(told)]


def matches(brands: Catalog, domain: Column, text: Column) -> Column:
    """The brands, in catalog order, with evidence in domain or text. Nothing is joined: no row meets a row. A null domain
    or text counts as empty."""
    kind = pa.list_(pa.struct([("brand", pa.string()), ("sector", pa.string()), ("category", pa.string()), ("evidence", pa.list_(pa.string()))]))

    @F.arrow_udf("array<struct<brand: string, sector: string, category: string, evidence: array<string>>>")
    def within(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        found = automaton(brands) if any(r[3] for r in brands.rows) else None
        for d, t in batches:
            rows = (x for i in range(0, len(t), AT_ONCE) for x in zip(d.slice(i, AT_ONCE).to_pylist(), t.slice(i, AT_ONCE).to_pylist(), strict=True))
            yield pa.array([evidence(found, brands, x or "", y or "") if found is not None else [] for x, y in rows], kind)

    return within(squash(domain), squash(F.coalesce(text, F.lit(""))))
