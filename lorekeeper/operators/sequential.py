"""Operators whose result depends on an order: windows around terms, and dedupe by either of two keys."""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import takewhile

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lorekeeper.operators.graph import parts
from lorekeeper.operators.ranking import first_by
from lorekeeper.operators.storage import shared_folder

#: Rows of keys that one task may hold, and the share of open rows above which a round has settled too few.
BLOCK, SLOW = 1 << 20, 0.7


def term_windows(docs: DataFrame, terms: list[str], width: int = 360, apart: int = 120, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, term, start, end): windows around the terms of a text in order; one whose ends are both within ``apart`` of a kept one's is left out."""
    pattern = re.compile("|".join(map(re.escape, sorted(terms, key=len, reverse=True))), re.I)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for key, text in zip(batch["id"], batch["text"]):
                kept: list[tuple[int, int]] = []
                for m in pattern.finditer(text or ""):
                    span = max(0, m.start() - width), min(len(text), m.end() + width)
                    near = takewhile(lambda s: span[0] - s[0] < apart, reversed(kept))  # noqa: B023  starts never fall
                    if not any(abs(span[1] - end) < apart for _, end in near):
                        kept.append(span)
                        out.append((key, m[0].lower(), *span))
            yield pd.DataFrame(out, columns=["id", "term", "start", "end"])

    kind = dict(docs.dtypes)[id_col]
    return docs.select(docs[id_col].alias("id"), docs[text_col].alias("text")).mapInPandas(run, f"id {kind}, term string, start long, end long").withColumnRenamed("id", id_col)


def _in_order(rows: pd.DataFrame) -> pd.DataFrame:
    """Of rows (_o, _a, _b), those kept by a pass in order."""
    rows = rows.sort_values(["_o", "_a", "_b"], ignore_index=True)
    seen_a, seen_b, kept = set(), set(), []
    for k, (a, b) in enumerate(zip(rows["_a"], rows["_b"])):
        if a not in seen_a and b not in seen_b:
            seen_a.add(a)
            seen_b.add(b)
            kept.append(k)
    return rows.iloc[kept][["_o", "_a", "_b"]]


def first_by_either(df: DataFrame, key_a: list[str], key_b: list[str], order: str) -> DataFrame:
    """Rows kept in order, unless an earlier kept row has their first or their second key. No two rows share an order, and none is null.

    What is kept depends on what was kept before, so two separate distincts are wrong. While more than BLOCK rows are
    open, rounds of set operations settle most: a row that comes first under both keys is kept, and rows that share a
    key with a kept one go. Where a round settles few, rows form long chains: then parts of rows that are
    connected by keys are passed through in order, each by itself and BLOCK rows of a part at once. What
    is left in the end, BLOCK rows at most, takes one pass. So the number of rounds doesn't follow the longest chain, no task holds more than BLOCK rows of keys, and
    every round is checkpointed.
    """
    shared_folder(df.sparkSession)
    digest = lambda keys: F.unhex(F.sha2(F.to_json(F.struct(*keys)), 256))
    left = df.select(F.col(order).alias("_o"), digest(key_a).alias("_a"), digest(key_b).alias("_b")).checkpoint()
    schema, kept, n = left.schema, left.limit(0), left.count()
    open_after = lambda rows, now: rows.join(now.select("_a"), "_a", "left_anti").join(now.select("_b"), "_b", "left_anti").select("_o", "_a", "_b").checkpoint()
    while n > BLOCK:
        first = lambda key: left.groupBy(key).agg(F.min("_o").alias(f"_first{key}"))
        now = left.join(first("_a"), "_a").join(first("_b"), "_b").where("_o = _first_a and _o = _first_b").select("_o", "_a", "_b").checkpoint()
        kept, left = kept.unionAll(now), open_after(left, now)
        before, n = n, left.count()
        if n > max(BLOCK, SLOW * before):
            sided = lambda key, side: F.concat(F.lit(side).cast("binary"), F.col(key))  # noqa: E731  one value may be a key of either kind
            edges = left.select(sided("_a", "a").alias("a"), sided("_b", "b").alias("b"))
            placed = left.withColumn("node", sided("_a", "a")).join(parts(edges), "node").select("part", "_o", "_a", "_b")
            some = first_by(placed, ["part"], ["_o"], BLOCK)
            now = some.groupBy("part").applyInPandas(_in_order, schema).checkpoint()
            kept = kept.unionAll(now)
            left = open_after(left, now)  # a row passed and not kept shares a key with a kept one
            n = left.count()
    now = left.withColumn("_one", F.lit(0)).groupBy("_one").applyInPandas(_in_order, schema)
    return df.join(kept.unionAll(now).select(F.col("_o").alias(order)), order, "left_semi")
